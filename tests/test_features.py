"""Feature table, keys, shares and metric views on hand-made rows."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from ebbtide.functions.columns import count_yes, fill_template, pad_id, safe_divide
from ebbtide.functions.hashing import categorical, uniform
from ebbtide.operators import explore as ex
from ebbtide.operators import features as ft
from ebbtide.operators.metricview import Metric, MetricView, UnknownMetric, customer_metrics
from ebbtide.session import shared_dir

TICKET = "customer_id bigint, ticket_id bigint, created_date timestamp_ntz, category string, priority string, " \
         "status string, resolution_time_hours double, description string"


def tickets(spark, data):
    return spark.createDataFrame(data, "customer_id bigint, ticket_id bigint, day int, category string, "
                                 "priority string, status string, hours double").select(
        "customer_id", "ticket_id", F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(day)").alias("created_date"),
        "category", "priority", "status", F.col("hours").alias("resolution_time_hours"),
        F.lit("text").alias("description"))


def test_feature_defaults(spark):
    t = tickets(spark, [
        (1, 1, 0, "billing", "high", "resolved", 4.0), (1, 2, 1, "technical", "low", "resolved", 8.0),
        (2, 3, 2, "billing", "critical", "open", None), (9, 4, 3, "general", "low", "open", None)])
    got = {r.customer_id: r for r in ft.ticket_features(t).collect()}
    assert (got[1].total_tickets, got[1].high_priority_tickets, got[1].avg_resolution_hours) == (2, 1, 6.0)
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint")
    joined = ft.fill_ticket_defaults(customers.join(ft.ticket_features(t), "customer_id", "left"))
    by = {r.customer_id: r for r in joined.collect()}
    assert set(by) == {1, 2, 3}  # the ticket of an unknown customer adds no row
    assert by[2].avg_resolution_hours == 0 and by[2].total_tickets == 1  # none resolved
    assert by[3].total_tickets == 0  # no tickets at all
    assert ft.ticket_features(t, as_of="2025-01-02 00:00:00").count() == 1


def test_scalars(spark):
    df = spark.createDataFrame([(10.0, 2), (10.0, 0), (10.0, None), (10.0, -1)], "a double, b int")
    assert [r[0] for r in df.select(safe_divide(F.col("a"), F.col("b"))).collect()] == [5.0, 0.0, 0.0, 0.0]
    s = spark.createDataFrame([("Yes", "Yes"), ("No internet service", None)], "x string, y string")
    assert [r[0] for r in s.select(count_yes(("x", "y"))).collect()] == [2, 0]
    p = spark.createDataFrame([(7,), (1234567,)], "n bigint").select(pad_id("A", F.col("n"), 5))
    assert [r[0] for r in p.collect()] == ["A-00007", "A-1234567"]
    f = spark.range(1).select(fill_template(F.lit("{a} and {b}"), {"a": F.lit(1), "b": F.lit("x")}))
    assert f.first()[0] == "1 and x"


def test_uniform_is_independent_of_partitions(spark):
    one = rows(spark.range(0, 500, 1, 1).select("id", uniform("id", "s")), "id")
    many = rows(spark.range(0, 500, 1, 16).repartition(7).select("id", uniform("id", "s")), "id")
    assert one == many and all(0 <= u < 1 for _, u in one)
    drawn = spark.range(4000).select(categorical(uniform("id", "c"), ["a", "b"], [0.25, 0.75]).alias("v"))
    share = drawn.filter("v = 'a'").count() / 4000
    assert 0.22 < share < 0.28


def test_keyed_write_rejects_bad_keys(spark):
    good = spark.createDataFrame([(1, 2), (2, 2)], "k int, v int")
    assert ft.keyed_write(good, shared_dir(spark, "k"), ["k"]).count() == 2
    for data in ([(1, 1), (1, 2)], [(None, 1)]):
        with pytest.raises(ft.KeyViolation):
            ft.keyed_write(spark.createDataFrame(data, "k int, v int"), shared_dir(spark, "k"), ["k"])


def test_shares(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "g string")
    assert rows(ex.share_of_total(df, "g"), "g") == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert ex.share_of_total(df.filter("false"), "g").count() == 0
    assert rows(ex.share_of_total(df.filter("g = 'b'"), "g")) == [("b", 1, 100.0)]


def test_latest_and_first_k(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (2, 1, 3)], "k int, at int, id int")
    assert rows(ex.latest_per(df, "k", "at", "id"), "k") == [(1, 5, 2), (2, 1, 3)]
    got = ex.first_k_per_class(df.withColumn("c", F.col("k").cast("string")), "c", "id", {"1": 1, "2": 3})
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_training_set_keeps_split(spark, tables):
    train = ft.training_set(tables.churn_labels, ft.build_features(tables.customers, tables.tickets))
    counts = dict(rows(train.groupBy("split").count()))
    assert counts == {"train": 109, "val": 24}
    labels = dict(rows(tables.churn_labels.select("customer_id", "split")))
    assert all(labels[r.customer_id] == r.split for r in train.select("customer_id", "split").collect())


def test_metric_view(spark):
    src = spark.createDataFrame([("x", "Yes", 1.0), ("x", "No", 3.0), (None, "No", 5.0)], "d string, churn string, m double")
    view = MetricView("v", src, {"d": Metric("d")}, {"n": Metric("count(*)"), "avg_m": Metric("avg(m)")})
    assert rows(view.query(["d"], ["n", "avg_m"], order_by=["d"])) == [(None, 1, 5.0), ("x", 2, 2.0)]
    assert rows(view.query([], ["n"])) == [(3,)]
    assert view.query(["d"], ["n"], where="m > 100").count() == 0
    with pytest.raises(UnknownMetric):
        view.query(["nope"], ["n"])
    with pytest.raises(UnknownMetric):
        view.query(["d"], ["nope"])
    with pytest.raises(AnalysisException):
        MetricView("v", src, {"d": Metric("d")}, {"bad": Metric("sum(count(*))")})
    with pytest.raises(AnalysisException):
        MetricView("v", src, {"d": Metric("missing")}, {"n": Metric("count(*)")})
    with pytest.raises(ValueError):
        MetricView("v", src, {"n": Metric("d")}, {"n": Metric("count(*)")})


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_measures_ignore_partitioning(tables, partitions):
    view = customer_metrics(tables.customers.repartition(partitions))
    total = view.query([], ["total_customers", "churned_customers"]).first()
    assert tuple(total) == (150, 32)


def test_a_bad_key_leaves_the_table(spark):
    path = shared_dir(spark, "kept")
    ft.keyed_write(spark.createDataFrame([(1, 2), (2, 3)], "k int, v int"), path, ["k"])
    with pytest.raises(ft.KeyViolation):
        ft.keyed_write(spark.createDataFrame([(1, 2), (1, 3)], "k int, v int"), path, ["k"])
    assert spark.read.parquet(path).count() == 2
    assert ft.keyed_write(spark.createDataFrame([(5, 5)], "k int, v int"), path, ["k"]).count() == 1
