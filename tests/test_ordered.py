"""Prefix sums, quantiles and draws against brute force."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators.joins import weighted_draw
from ebbtide.operators.ordered import exact_quantiles, ordered_prefix, slice_edges
from ebbtide.functions.hashing import uniform
from ebbtide.operators.profile import column_profile


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(-5, 5).map(float)), min_size=1, max_size=60),
       st.sampled_from([1, 3, 64]))
def test_prefix_equals_sorted_running_sum(spark, values, cells):
    counts = {}
    for v in values:
        counts[v + 0.0] = counts.get(v + 0.0, 0) + 1
    df = spark.createDataFrame([("a", v, n) for v, n in counts.items()], "g string, v double, n bigint")
    got = {r.v: (r.cum_n, r.total_n, r.next_value) for r in ordered_prefix(df, ["g"], "v", ["n"], cells).collect()}
    order, run = sorted(counts), 0
    for i, v in enumerate(order):
        run += counts[v]
        assert got[v] == (run, len(values), order[i + 1] if i + 1 < len(order) else None)


@pytest.mark.parametrize("cells", [1, 7, 4096])
def test_quantiles_equal_numpy(spark, cells):
    rng = random.Random(3)
    values = [round(rng.lognormvariate(0, 3), 3) for _ in range(400)] + [5.0] * 200
    df = spark.createDataFrame([(v,) for v in values], "v double").groupBy("v").agg(F.count("*").alias("n"))
    got = exact_quantiles(df, [], "v", "n", {"a": 0.1, "b": 0.5, "c": 0.99}, cells).first()
    assert got.a == pytest.approx(np.quantile(values, 0.1))
    assert got.b == pytest.approx(np.quantile(values, 0.5))
    assert got.c == pytest.approx(np.quantile(values, 0.99))


@pytest.mark.parametrize("cells,partitions", [(1, 1), (5, 4), (4096, 16)])
def test_weighted_draw_is_the_interval_lookup(spark, cells, partitions):
    weights = {1: 0, 2: 5, 3: 1, 4: 90, 5: 1, 6: 0, 7: 3}  # one key draws nearly everything
    pool = spark.createDataFrame(list(weights.items()), "id bigint, w int")
    draws = spark.range(300).withColumnRenamed("id", "n").repartition(partitions)
    got = {r.n: r.id for r in weighted_draw(draws, "n", pool, "id", F.col("w"), "t", cells).collect()}
    edges, run = [], 0
    for k, w in weights.items():
        edges.append((run, run + w, k))
        run += w
    us = {r.n: r.u for r in draws.select("n", uniform("n", "t").alias("u")).collect()}
    assert len(got) == 300
    for n, u in us.items():
        at = int(u * run)
        assert got[n] == next(k for lo, hi, k in edges if lo <= at < hi)
    assert not {1, 6} & set(got.values())


def test_slices_follow_the_rows(spark):
    """Crowded values and one outlier: no slice holds much more than its share."""
    crowded = spark.range(200_000).select((F.lit(1e15) + F.col("id")).alias("v")).union(spark.createDataFrame([(0.0,)], "v double"))
    crowded = crowded.withColumn("g", F.lit(None).cast("string"))
    edges = slice_edges(crowded, ["g"], "v", 1024).first()["_edges"]
    inner = np.searchsorted(edges, 1e15 + np.arange(200_000), side="left")
    assert np.bincount(inner).max() <= 0.01 * 200_001


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 4.0), ("a", 1.0)], "g string, v double")
    got = {r.g: (r.distinct_count, r.median) for r in column_profile(df, ["g"], ["v"]).collect()}
    assert got == {None: (2, 3.5), "a": (1, 1.0)}


def test_plan_stays_small(spark, monkeypatch):
    """Levels of slices do not double the plan: edges and totals are read back, rows stand in it once or twice."""
    from ebbtide.operators import drift as dr
    from ebbtide.operators import ordered

    monkeypatch.setattr(ordered, "SLICE_ROWS", 8)
    monkeypatch.setattr(ordered, "CELLS", 8)
    leaves = lambda d: d._jdf.queryExecution().analyzed().collectLeaves().size()
    df = spark.range(40).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    assert len(ordered.slice_levels(40)) == 3
    summed = ordered.ordered_prefix(df, ["g"], "v", ["n"], rows=40)
    assert leaves(summed) <= 10
    assert sorted((r.g, r.v, r.cum_n) for r in summed.collect()) == sorted((i % 2, float(i), i // 2 + 1) for i in range(40))
    assert leaves(ordered.carry_at(df, df.select("g", "v"), ["g"], "v", "m", rows=40)) <= 13
    monkeypatch.setattr(ordered, "SLICE_ROWS", 20)
    rows = spark.range(20).select(F.lit(None).cast("timestamp_ntz").alias("window"), (F.col("id") * 1.5).alias("v"))
    assert leaves(dr.numeric_distances(dr.compare(rows, rows, ["v"]))) <= 10
