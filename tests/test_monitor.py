"""Drift, profile and quality on edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from ebbtide.operators import drift as dr
from ebbtide.operators import monitor as mo
from ebbtide.operators import profile as pf
from ebbtide.operators import quality as ql
from ebbtide.operators.features import build_features


def frame(spark, data):
    return spark.createDataFrame(data, "day string, x double, c string").withColumn("ts", F.col("day").cast("timestamp_ntz"))


def measures(spark, base, log, numeric=("x",), categorical=("c",)):
    out = dr.drift(frame(spark, log), frame(spark, base), "ts", numeric, categorical)
    return {(str(r["window"])[:7], r.column_name): r for r in out.collect()}


def test_identical_samples_do_not_drift(spark):
    data = [("2025-07-03", float(i % 7), "ab"[i % 2]) for i in range(70)]
    got = measures(spark, data, data)
    x, c = got[("2025-07", "x")], got[("2025-07", "c")]
    for r in (x, c):
        assert r.population_stability_index == pytest.approx(0) and r.js_distance == pytest.approx(0)
        assert r.tv_distance == pytest.approx(0)
    assert x.ks_test.statistic == 0 and x.ks_test.pvalue == 1 and x.wasserstein_distance == 0
    assert c.chi_squared_test.statistic == pytest.approx(0) and c.chi_squared_test.pvalue == pytest.approx(1)
    assert x.chi_squared_test is None and c.ks_test is None


def test_disjoint_samples_and_unseen_categories(spark):
    base = [("2025-06-01", float(i), "a") for i in range(20)]
    log = [("2025-07-01", 100.0 + i, "b") for i in range(20)]
    got = measures(spark, base, log)
    assert got[("2025-07", "x")].ks_test.statistic == 1
    assert got[("2025-07", "x")].wasserstein_distance == pytest.approx(100)
    c = got[("2025-07", "c")]
    assert c.tv_distance == 1 and c.js_distance == pytest.approx(math.sqrt(math.log(2)))
    assert c.max_bin_diff == 1 and c.degrees == 1


def test_month_boundary_constant_and_null_columns(spark):
    base = [("2025-06-01", 1.0, None), ("2025-06-02", 1.0, None)]
    log = [("2025-07-31 23:59:59", 1.0, None), ("2025-08-01", 1.0, None)]
    got = measures(spark, base, log)
    assert set(got) == {("2025-07", "x"), ("2025-08", "x")}  # an all-null column has nothing to compare
    assert got[("2025-08", "x")].ks_test.statistic == 0


def test_ks_and_w1_equal_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(0.5, 2, 200).round(2)
    got = measures(spark, [("2025-06-01", float(v), "a") for v in a], [("2025-07-01", float(v), "a") for v in b])
    grid = np.unique(np.concatenate([a, b]))
    fa, fb = np.searchsorted(np.sort(a), grid, "right") / len(a), np.searchsorted(np.sort(b), grid, "right") / len(b)
    r = got[("2025-07", "x")]
    assert r.ks_test.statistic == pytest.approx(np.abs(fa - fb).max())
    assert r.wasserstein_distance == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())


def test_w1_of_a_shift_is_the_shift(spark):
    base = [("2025-06-01", float(i), "a") for i in range(50)]
    log = [("2025-07-01", float(i) + 2.5, "a") for i in range(50)]
    assert measures(spark, base, log)[("2025-07", "x")].wasserstein_distance == pytest.approx(2.5)


def test_chi2_tail_against_spark(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.mllib.linalg import Vectors as OldVectors
    from pyspark.mllib.stat import Statistics

    assert Vectors is not None
    for seen in ([10.0, 20.0], [5.0, 7.0, 30.0], [1.0, 2.0, 3.0, 40.0], [9.0, 9.0, 9.0, 12.0, 1.0]):
        theirs = Statistics.chiSqTest(OldVectors.dense(seen))
        assert dr.chi2_tail(theirs.statistic, len(seen) - 1) == pytest.approx(theirs.pValue, rel=1e-6, abs=1e-12)


def test_status_and_alerts(spark):
    schema = "column_name string, window string, population_stability_index double, " \
             "ks_test struct<statistic:double,pvalue:double>, chi_squared_test struct<statistic:double,pvalue:double>"
    df = spark.createDataFrame([
        ("a", "w", 0.3, None, None), ("b", "w", 0.15, None, None), ("c", "w", 0.0, (0.5, 0.01), None),
        ("d", "w", None, None, (9.0, 0.01)), ("e", "w", 0.1, None, None)], schema)
    assert dict(rows(dr.drift_status(df).select("column_name", "drift_status"))) == {
        "a": "MAJOR DRIFT", "b": "MODERATE DRIFT", "c": "SIGNIFICANT", "d": "SIGNIFICANT", "e": "STABLE"}
    assert [r.column_name for r in dr.drift_alerts(df).orderBy("column_name").collect()] == ["a", "b", "c", "d"]
    assert [r.column_name for r in dr.drift_rank(df).collect()] == ["a", "b", "e", "c", "d"]


def labelled(spark, data):
    return spark.createDataFrame(data, "y double, p double").withColumn("hat", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))


@pytest.mark.parametrize("data,area", [
    ([(1.0, 0.5), (0.0, 0.5), (1.0, 0.5)], 0.5), ([(1.0, 0.9), (0.0, 0.1)], 1.0), ([(1.0, 0.9), (1.0, 0.1)], None)])
def test_auc_edges(spark, data, area):
    assert ql.roc_auc(labelled(spark, data), "y", "p").first()[0] == area


def test_auc_of_reversed_score(spark):
    rng = np.random.default_rng(2)
    df = labelled(spark, [(float(rng.integers(0, 2)), float(rng.integers(0, 9)) / 10) for _ in range(200)])
    a = ql.roc_auc(df, "y", "p").first()[0]
    b = ql.roc_auc(df.withColumn("p", -F.col("p")), "y", "p").first()[0]
    assert a + b == pytest.approx(1)


def test_quality_without_positive_predictions_or_labels(spark):
    q = ql.quality(labelled(spark, [(1.0, 0.1), (0.0, 0.2)]), "y", "hat", "p").first()
    assert (q.precision_positive, q.recall_positive, q.f1_positive, q.accuracy_score) == (0, 0, 0, 0.5)
    none = spark.createDataFrame([(None, 0.5, 1.0)], "y double, p double, hat double")
    assert ql.quality(none, "y", "hat").first().labeled_rows == 0
    cells = {(r.label, r.prediction): r.n for r in ql.confusion_matrix(labelled(spark, [(1.0, 0.1)]), "y", "hat").collect()}
    assert cells == {(0.0, 0.0): 0, (0.0, 1.0): 0, (1.0, 0.0): 1, (1.0, 1.0): 0}
    unwrapped = ql.unwrap_averages(ql.quality(labelled(spark, [(1.0, 0.9)]), "y", "hat"))
    assert unwrapped.schema["precision"].dataType.typeName() == "double"
    assert ql.unwrap_averages(unwrapped).columns == unwrapped.columns  # plain numbers pass through


def test_placeholders():
    assert pf.fill_placeholders("sum({{prediction_col}})", {"prediction_col": "p"}) == "sum(`p`)"
    with pytest.raises(ValueError):
        pf.fill_placeholders("sum({{other}})", {"prediction_col": "p"})


def test_refresh_has_all_rows(spark, tables):
    features = build_features(tables.customers, tables.tickets)
    log = mo.build_inference_log(tables.churn_labels, features)
    base = mo.build_baseline(tables.churn_labels, features)
    metrics, moved = mo.monitor_refresh(log, base, mo.MonitorConfig(slices=("contract_type",)))
    got = metrics.groupBy("log_type", "slice_key", "column_name").count().collect()
    kinds = {(r.log_type, r.slice_key) for r in got}
    assert kinds == {("INPUT", None), ("INPUT", "contract_type"), ("BASELINE", None), ("BASELINE", "contract_type")}
    table = metrics.filter("column_name = ':table' and slice_key is null and log_type = 'INPUT'").collect()
    assert [r["count"] for r in table] == [17, 17] and all(r.high_risk_percentage is not None for r in table)
    assert {r.column_name for r in moved.collect()} >= {"prediction", "monthly_charges", "contract_type"}
