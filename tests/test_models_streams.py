"""Model path, generated tables and streams."""

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import churn_model as cm
from ebbtide.operators import lookup as lk
from ebbtide.operators import synth as sy
from ebbtide.operators.quality import roc_auc
from ebbtide.plans.models import SMALL_SPACE
from ebbtide.session import shared_dir
from ebbtide.streaming import profile as sp
from ebbtide.streaming import sync as ss


@pytest.fixture(scope="module")
def made(spark):
    """1,500 generated customers with a churn signal in them."""
    rows = cm.prepare(sy.synth_customers(sy.keys(spark, 1500)))
    split = sy.synth_labels(rows).select("customer_id", "split")
    return rows.drop("name", "gender").join(split, "customer_id").cache()


def test_model_beats_chance_and_survives_reload(spark, made):
    train, test = made.filter("split = 'train'"), made.filter("split = 'test'")
    model = cm.fit_final(train, {"maxIter": 8, "maxDepth": 3})
    scored = cm.score(model, test)
    assert roc_auc(scored, "label", "churn_probability").first()[0] > 0.6
    store = cm.ModelStore(spark, shared_dir(spark, "store"))
    assert store.register("m", model, 0.5, 0.7) == 1 and store.register("m", model) == 2
    store.set_alias("m", "Champion", 1)
    store.set_alias("m", "Champion", 2)
    again = cm.score(store.load("m", "Champion"), test)
    pairs = scored.select("customer_id", F.col("churn_probability").alias("a")).join(
        again.select("customer_id", F.col("churn_probability").alias("b")), "customer_id")
    assert pairs.filter("a <> b").count() == 0
    with pytest.raises(KeyError):
        store.load("m", "Challenger")
    names = dict(cm.importances(model, test))
    assert "contract_type" in names and abs(sum(names.values()) - 1) < 1e-6
    moved = {r.column_name: r.auc_drop for r in cm.permutation_importance(
        model, test, ["contract_type", "partner"], rows_per_bucket=50).collect()}
    assert moved["contract_type"] > moved["partner"] - 0.01


def test_tuning_is_seeded(made):
    assert cm.draw_params(3, 1, cm.SPACE) == cm.draw_params(3, 1, cm.SPACE)
    assert cm.draw_params(3, 1, cm.SPACE) != cm.draw_params(4, 1, cm.SPACE)
    found = cm.tune(made.filter("split = 'train'"), made.filter("split = 'val'"), 2, space=SMALL_SPACE)
    table = found.trials.collect()
    assert len(table) == 2 and sum(r.is_best for r in table) == 1
    assert found.best == cm.draw_params(next(r.trial for r in table if r.is_best), 42, SMALL_SPACE)


def test_unseen_category_is_accepted(made):
    model = cm.fit_final(made.filter("contract_type <> 'Two year'"), {"maxIter": 2, "maxDepth": 2})
    assert cm.score(model, made.filter("contract_type = 'Two year'")).filter("churn_probability is null").count() == 0


def test_generated_customers(spark):
    a = sy.synth_customers(sy.keys(spark, 3000))
    b = sy.synth_customers(sy.keys(spark, 3000).repartition(7))
    assert a.exceptAll(b).count() == 0 and len(a.columns) == 22
    assert sy.synth_customers(sy.keys(spark, 3000), seed=7).exceptAll(a).count() > 2900
    share = a.filter("churn = 'Yes'").count() / 3000
    assert 0.2 < share < 0.36
    assert a.filter("total_charges < monthly_charges or tenure_months < 1").count() == 0
    rate = {r[0]: r[1] for r in a.groupBy("contract_type").agg(
        F.avg((F.col("churn") == "Yes").cast("int"))).collect()}
    assert rate["Month-to-month"] > rate["One year"] > 0


def test_generated_tickets_and_calls(spark):
    customers = sy.synth_customers(sy.keys(spark, 200))
    tickets = sy.synth_tickets(customers, sy.keys(spark, 6000))
    assert tickets.count() == 6000
    per = tickets.join(customers.select("customer_id", "churn"), "customer_id").groupBy("churn").count()
    n = {r.churn: r["count"] for r in per.collect()}
    k = {r.churn: r["count"] for r in customers.groupBy("churn").count().collect()}
    assert 2.5 < (n["Yes"] / k["Yes"]) / (n["No"] / k["No"]) < 3.5
    assert tickets.filter("(status = 'resolved') <> (resolution_time_hours is not null)").count() == 0
    calls = sy.synth_transcripts(customers, sy.keys(spark, 300))
    assert calls.count() == 300 and calls.filter(F.col("transcript_text").contains("{")).count() == 0


def test_bill_total(spark):
    customers = sy.synth_customers(sy.keys(spark, 50))
    lines = sy.bill_lines(customers)
    sums = lines.groupBy("customer_id").agg(
        F.sum(F.when(F.col("item") != "total", F.col("cents"))).alias("a"),
        F.max(F.when(F.col("item") == "total", F.col("cents"))).alias("b"))
    assert sums.filter("a <> b").count() == 0 and sums.count() == 50


def test_lookups(spark, tables):
    predictions = spark.createDataFrame([(1, 0.2), (1, 0.9), (2, 0.4)], "customer_id bigint, churn_probability double")
    ids = spark.createDataFrame([(1,), (3,)], "customer_id bigint")
    assert {r.customer_id: r.churn_risk for r in lk.churn_risk(predictions, ids).collect()} == {1: 0.9, 3: None}
    assert lk.customer_profile(tables.customers, ids).count() == 2
    assert lk.retention_policy(lk.policies(spark)).count() == 4
    assert lk.latest_ticket(tables.tickets).count() == 1


def test_sync_is_incremental_and_repeatable(spark):
    root, target, checkpoint = (shared_dir(spark, x) for x in ("src", "dst", "cp"))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"

    def publish(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(root)
        ss.sync(stream, "doc_id", target, checkpoint, lambda b: ss.embed(b.select("doc_id", "lang", "text")))
        return {r.doc_id: r.text for r in ss.latest(spark, target, "doc_id").collect()}

    publish("a", [(1, "old words", "en", "s", 9), (2, "kept", "en", "s", 4)])
    assert run() == {1: "old words", 2: "kept"}
    publish("b", [(1, "new words", "en", "s", 9)])
    assert run() == {1: "new words", 2: "kept"}
    assert run() == {1: "new words", 2: "kept"}
    norm = ss.latest(spark, target, "doc_id").select(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).first()[0]
    assert norm == pytest.approx(1, abs=1e-5)


def test_stream_equals_batch_on_closed_windows(spark, tables):
    path, checkpoint = shared_dir(spark, "p"), shared_dir(spark, "pc")
    stream = sp.windowed_profile(ss.file_stream(spark, tables.root, "events"), "ts", "event_type", "value")
    sp.run_to_table(stream, path, checkpoint)
    closed = spark.read.parquet(path)
    batch = sp.windowed_profile(tables.raw("events"), "ts", "event_type", "value")
    keys = ["window_start", "event_type", "count", "min", "max"]
    assert closed.select(*keys).exceptAll(batch.select(*keys)).count() == 0
    assert 0 < closed.count() < batch.count()  # the last windows stay open


def test_streams_read_folders(spark, tmp_path):
    data = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    data.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    target = f"{tmp_path}/target"
    ss.sync(ss.file_stream(spark, str(tmp_path), "events"), "event_id", target, f"{tmp_path}/ck", lambda b: b)
    assert ss.latest(spark, target, "event_id").count() == data.count()
    with pytest.raises(FileNotFoundError):
        ss.file_stream(spark, str(tmp_path), "documents")


def test_a_version_is_never_overwritten(spark):
    from pyspark.ml import Pipeline

    store = cm.ModelStore(spark, shared_dir(spark, "store"))
    model = Pipeline(stages=[]).fit(spark.range(1))
    model.write().save(f"{store.root}/m/v1")  # another writer was first
    with pytest.raises(Exception, match="exist"):
        store.register("m", model)


@pytest.fixture
def searches(monkeypatch):
    """The trials and space that the named queries ask for; the search itself runs in the short space."""
    from ebbtide.plans import models

    asked, full, tune = [], dict(cm.SPACE), cm.tune
    monkeypatch.setattr(models, "_SHARED", {})
    monkeypatch.setattr(cm, "SPACE", SMALL_SPACE)

    def counted(train, val, n_trials=20, **rest):
        asked.append((n_trials, rest["space"] is SMALL_SPACE and full["maxIter"] == ("int", 50, 300)))
        return tune(train, val, n_trials, **rest)

    monkeypatch.setattr(cm, "tune", counted)
    return asked


def test_model_queries_share_the_best_of_20_trials(spark, searches, monkeypatch):
    from ebbtide.plans import models
    from ebbtide.sources.tables import Tables

    stores = []
    monkeypatch.setattr(cm, "ModelStore", lambda *a, make=cm.ModelStore: stores.append(make(*a)) or stores[-1])
    trials = models.ml_tune(Tables(spark, "/root/testdata/sf0.001")).collect()
    assert sorted(r.trial for r in trials) == list(range(20)) and sum(r.is_best for r in trials) == 1
    scored = models.ml_persist_load(Tables(spark, "/root/testdata/sf0.001"))
    assert searches == [(20, True)]  # once, and in the space of ``tune`` itself
    (store,) = stores
    held = store.manifest().collect()
    assert all(r.f1_score is not None for r in held if r.alias is None) and {r.alias for r in held} == {None, "Champion", "Challenger"}
    f1 = {r.version: r.f1_score for r in held if r.alias is None}
    assert len(f1) == 2 and f1[2] == max(r.f1_score for r in trials)
    assert {r.version for r in scored.collect()} == {2 if f1[2] >= f1[1] else 1}


def test_importance_has_every_model_input(tables, searches):
    from ebbtide.plans import models

    inputs = {c for group in cm.split_columns_by_type(models._split(tables, "val"), cm.SKIP) for c in group}
    got = models.ml_importance(tables).collect()
    assert {r.column_name for r in got} == inputs and len(got) == len(inputs) > 5
    assert sum(r.split_importance for r in got) == pytest.approx(1)


def test_stream_profile_has_the_open_windows(tables):
    from ebbtide.plans import streams

    got = streams.stream_profile(tables)
    want = tables.raw("events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(
        F.count("*").alias("count"), F.round(F.avg("value"), 6).alias("avg"), F.min("value").alias("min"), F.max("value").alias("max"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.agg(F.sum("count")).first()[0] == tables.raw("events").count()
