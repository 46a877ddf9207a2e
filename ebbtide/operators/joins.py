"""Joins that need more than a plain equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.hashing import uniform
from ebbtide.operators.ordered import carry_at, ordered_prefix
from ebbtide.sources.sinks import materialize_once


def membership_flag(rows: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """Add whether the key is in the member set."""
    marked = members.select(key).distinct().withColumn("_in", F.lit(True))
    return rows.join(marked, key, "left").withColumn(name, F.coalesce("_in", F.lit(False))).drop("_in")


def weighted_draw(
    draws: DataFrame, draw_key: str, pool: DataFrame, pool_key: str, weight: Column, seed: str, cells: int | None = None
) -> DataFrame:
    """For every draw, a pool key with probability in proportion to its integer weight.

    The pool gets integer intervals by a running total in key order, the draws an integer
    position from their hash uniform, and each draw takes the interval it falls into. The
    lookup sorts both sides together slice by slice, with slices cut where the draws lie, so
    its cost does not depend on how the weights are spread. A zero weight is never drawn. Weights and intervals are read
    several times and therefore stored once.
    """
    # Text keys are ordered by their hash; the order only has to be the same for all readers.
    is_text = pool.schema[pool_key].dataType.typeName() == "string"
    place = F.xxhash64(pool_key) if is_text else F.col(pool_key)
    weighted = pool.select(pool_key, weight.cast("bigint").alias("_w"), place.alias("_place")).filter(F.col("_w") > 0)
    weighted = materialize_once(weighted, "weights")
    starts = materialize_once(
        ordered_prefix(weighted, [], "_place", ["_w"], cells, (pool_key,)).select(
            pool_key, (F.col("cum__w") - F.col("_w")).alias("_at")), "starts")
    total = weighted.agg(F.sum("_w").alias("total")).scalar()
    probes = draws.withColumns({
        "_at": F.least(F.floor(uniform(draw_key, seed) * total).cast("bigint"), total - F.lit(1)), "_one": F.lit(0)})
    found = carry_at(starts.withColumn("_one", F.lit(0)), probes, ["_one"], "_at", "_hit", cells=cells)
    return found.select(*draws.columns, F.col(f"_hit.{pool_key}").alias(pool_key))


def compare_versions(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """Two runs side by side: key, a, b, delta; a side without the key stays null."""
    left = a.select(*key, F.col(value).alias("a"))
    right = b.select(*key, F.col(value).alias("b"))
    return left.join(right, key, "full").withColumn("delta", F.col("b") - F.col("a"))
