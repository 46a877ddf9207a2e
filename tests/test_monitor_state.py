"""Drift in slices, sketches, streams with timers, snapshots, labels in time, span trees and attributions."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import attributions as at
from ebbtide.operators import churn_model as cm
from ebbtide.operators import documents as dc
from ebbtide.operators import drift as dr
from ebbtide.operators import pointintime as pit
from ebbtide.operators import sketches as sk
from ebbtide.operators import spans as sp
from ebbtide.operators import synth as sy
from ebbtide.operators.ordered import carry_at, ordered_prefix, slice_levels
from ebbtide.session import shared_dir
from ebbtide.streaming import changes as ch
from ebbtide.streaming import windows as wd


# ---- slices ---------------------------------------------------------------------------

def test_levels_follow_the_rows(monkeypatch):
    assert slice_levels(100_000) == [] and len(slice_levels(10 ** 6)) == 1 and len(slice_levels(10 ** 7)) == 2
    assert slice_levels(5, 7) == [7] and slice_levels(5, 1) == []


@pytest.mark.parametrize("size", [1_000_000, 60])
def test_nested_slices_sum_and_carry(spark, monkeypatch, size):
    from ebbtide.operators import ordered

    monkeypatch.setattr(ordered, "SLICE_ROWS", size)
    monkeypatch.setattr(ordered, "CELLS", 16)
    draw = random.Random(size)
    values = {g: sorted({draw.randrange(500) for _ in range(n)}) for g, n in (("a", 160), ("b", 3), (None, 40))}
    df = spark.createDataFrame([(g, v, v % 7) for g, vs in values.items() for v in vs], "g string, v long, n long")
    got = {(r.g, r.v): (r.cum_n, r.total_n, r.next_value) for r in ordered_prefix(df, ["g"], "v", ["n"]).collect()}
    for g, vs in values.items():
        run = 0
        for i, v in enumerate(vs):
            run += v % 7
            assert got[g, v] == (run, sum(x % 7 for x in vs), vs[i + 1] if i + 1 < len(vs) else None)
    probes = [(g, draw.randrange(-5, 510), i) for i, g in enumerate(draw.choices(["a", "b", None, "none"], k=300))]
    marks = df.select("g", "v", F.col("n").alias("held"))
    found = carry_at(marks, spark.createDataFrame(probes, "g string, v long, i long"), ["g"], "v", "m").collect()
    assert len(found) == 300
    for r in found:
        before = [v for v in values.get(r.g, []) if v <= r.v]
        assert (r.m.v, r.m.held) == (before[-1], before[-1] % 7) if before else r.m is None


# ---- drift ----------------------------------------------------------------------------

def plain_drift(base, log):
    """KS and Wasserstein of two lists."""
    grid = np.unique(np.concatenate([base, log]))
    a, b = (np.searchsorted(np.sort(x), grid, "right") / len(x) for x in (base, log))
    return np.abs(a - b).max(), (np.abs(a - b)[:-1] * np.diff(grid)).sum()


@pytest.mark.parametrize("kind", ["normal", "ties", "inside", "outside", "one"])
def test_numbers_against_numpy(spark, kind):
    rng = np.random.default_rng(len(kind))
    base = {"normal": rng.normal(size=200), "ties": rng.integers(0, 6, 300).astype(float), "inside": rng.normal(size=50) * 100,
            "outside": rng.normal(size=80), "one": np.array([3.0])}[kind]
    logs = {"2025-07": {"normal": rng.normal(1, 2, 150), "ties": rng.integers(2, 9, 70).astype(float), "inside": rng.normal(size=300),
                        "outside": rng.normal(size=60) + 50, "one": np.array([3.0, 4.0, 2.0])}[kind], "2025-08": base[:40]}
    rows = lambda month, xs: [(f"{month}-02", float(x)) for x in xs]
    schema = "day string, x double"
    b = spark.createDataFrame(rows("2025-06", base), schema).withColumn("ts", F.col("day").cast("timestamp_ntz"))
    w = spark.createDataFrame([r for m, xs in logs.items() for r in rows(m, xs)], schema).withColumn("ts", F.col("day").cast("timestamp_ntz"))
    got = {str(r["window"])[:7]: r for r in dr.drift(w, b, "ts", ["x"]).collect()}
    for month, xs in logs.items():
        ks, w1 = plain_drift(base, xs)
        assert got[month].ks_test.statistic == pytest.approx(ks) and got[month].wasserstein_distance == pytest.approx(w1, abs=1e-9)


def test_categories_that_a_window_lacks(spark):
    base = [("2025-06-01", c, s) for c, n in (("a", 40), ("b", 30), ("c", 30), ("d", 5), ("e", 5)) for s in ("u", "v") for _ in range(n)]
    log = [("2025-07-01", c, s) for c, n in (("a", 10), ("b", 3), ("z", 2)) for s in ("u", "u", "w") for _ in range(n)] + [("2025-08-01", None, "u")]
    make = lambda rows: spark.createDataFrame(rows, "day string, c string, s string").withColumn("ts", F.col("day").cast("timestamp_ntz"))
    got = dr.drift(make(log), make(base), "ts", [], ["c"], slices=["s"]).collect()
    by = {(str(r["window"])[:7], r.slice_key, r.slice_value): r for r in got}
    q = {"a": 40 / 110, "b": 30 / 110, "c": 30 / 110, "d": 5 / 110, "e": 5 / 110}
    p = {"a": 10 / 15, "b": 3 / 15, "z": 2 / 15}
    keys = set(p) | set(q)
    gaps = {k: abs(p.get(k, 0) - q.get(k, 0)) for k in keys}
    for key in (("2025-07", None, None), ("2025-07", "s", "u")):
        r = by[key]
        assert r.tv_distance == pytest.approx(sum(gaps.values()) / 2) and r.max_bin_diff == pytest.approx(max(gaps.values())) and r.degrees == 5
        f = lambda x: max(x, 1e-4)
        assert r.population_stability_index == pytest.approx(sum((f(p.get(k, 0)) - f(q.get(k, 0))) * np.log(f(p.get(k, 0)) / f(q.get(k, 0))) for k in keys))
        n = 45 if key[1] is None else 30
        want = sum((p.get(k, 0) * n - e) ** 2 / e for k in keys for e in [(q.get(k, 0) or 1e-4) * n])
        assert r.chi_squared_test.statistic == pytest.approx(want)
        mid = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in keys}
        js = sum(0.5 * x * np.log(x / mid[k]) for side in (p, q) for k, x in side.items())
        assert r.js_distance == pytest.approx(np.sqrt(js))
    assert by["2025-07", "s", "w"].tv_distance is None  # a slice that the baseline lacks
    assert by["2025-07", "s", "v"].tv_distance is None and by["2025-08", None, None].tv_distance is None


# ---- sketches -------------------------------------------------------------------------

def test_sketches_merge_to_the_whole(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.lognormvariate(0, 2) + 1e6, rng.choice(["x"] * 90 + [f"y{i}" for i in range(10)])) for _ in range(6000)]
    rows += [("a", None, None), ("b", 0.0, "x"), ("c", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, t string")
    parts = [sk.partial_profile(df.filter(F.abs(F.xxhash64("v", "t")) % 3 == i), ["g"], ["v"], ["t"]) for i in range(3)]
    state = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {(r.g, r.column_name): r for r in sk.read_profile(state, ["g"]).collect()}
    for g in "abc":
        values = [v for k, v, _ in rows if k == g and v is not None]
        texts = [t for k, _, t in rows if k == g and t is not None]
        total = sum(k == g for k, _, _ in rows)
        r, t = got[g, "v"], got[g, "t"]
        assert r["count"] == len(values) and r.percent_nulls == pytest.approx(100 * (total - len(values)) / total)
        assert t["count"] == len(texts) and t.avg is None and t.median is None
        if not values:
            assert r.avg is None and r.median is None and r.distinct_count == 0
            continue
        assert r.avg == pytest.approx(np.mean(values)) and r.stddev == pytest.approx(np.std(values, ddof=1), rel=1e-9)
        assert (r.min, r.max) == (min(values), max(values))
        assert abs(r.distinct_count - len(set(values))) <= 4 * sk.DISTINCT_ERROR * len(set(values))
        for name, p in sk.QUANTILES.items():
            rank = np.searchsorted(np.sort(values), r[name], "right") / len(values)
            assert abs(rank - p) <= 2 * sk.RANK_ERROR + 1 / len(values)
        assert t.frequent[0].item == "x" and t.frequent[0]["count"] >= texts.count("x")


def test_a_refresh_reads_new_files_only(spark, tmp_path):
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/ck"
    for run in range(2):
        spark.range(run * 100, run * 100 + 100).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v")).write.parquet(f"{source}/{run}")
        stream = spark.readStream.schema("g long, v double").option("recursiveFileLookup", "true").parquet(source)
        sk.refresh(stream, path, checkpoint, ["g"], ["v"])
    state = spark.read.parquet(path)
    assert {r["batch"]: r["rows"] for r in state.groupBy("batch").agg(F.sum("rows").alias("rows")).collect()} == {0: 100, 1: 100}
    got = {r.g: r for r in sk.read_profile(sk.state_of(spark, path), ["g"]).collect()}
    assert got[0]["count"] == 100 and got[0].avg == pytest.approx(99) and got[1].max == 199


# ---- streams --------------------------------------------------------------------------

def test_windows_close_late_rows_are_counted_and_the_rest_is_open(spark, tmp_path):
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"
    hour = 3600
    batches = [[(0, "a", 1.0), (100, "a", None), (hour + 5, "b", 2.0)],
               [(3 * hour, "a", 5.0), (50, "a", 3.0), (None, "a", 9.0), (2 * hour, None, 4.0)],
               [(60, "a", 7.0), (hour + 70, "b", 8.0), (3 * hour + 1, "a", 6.0)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "s long, k string, v double").select(
            F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "k", "v").coalesce(1).write.parquet(f"{source}/{k}")
        stream = spark.readStream.schema("ts timestamp_ntz, k string, v double").option("recursiveFileLookup", "true").parquet(source)
        wd.run_windows(wd.windowed(stream, "ts", "k", "v", hour * 1000, "10 minutes"), path, checkpoint)
    got = {(r.kind, r.by, int(r.s)): (r["count"], r.avg, r.nulls) for r in wd.read_windows(spark, path, checkpoint).withColumn(
        "s", F.unix_seconds("window_start")).collect()}
    assert got == {("closed", "a", 0): (3, 2.0, 1), ("late", "a", 0): (1, 7.0, 0), ("closed", "b", hour): (1, 2.0, 0),
                   ("late", "b", hour): (1, 8.0, 0), ("open", "a", 3 * hour): (2, 5.5, 0), ("open", None, 2 * hour): (1, 4.0, 0)}


# ---- snapshots ------------------------------------------------------------------------

@pytest.mark.parametrize("depth", [0, 1, 2])
def test_changes_of_two_snapshots(spark, depth):
    schema = "k long, j string, v double, w array<int>"
    old = [(i, "x", float(i), [i]) for i in range(200)] + [(None, "n", 1.0, None), (500, "twice", 1.0, None), (500, "twice", 2.0, None), (600, "same", 1.0, None), (600, "same", 1.0, None)]
    new = [r for r in old if r[0] not in (3, 4)]
    new = [(k, j, v + 100 if k in (7, 8) else v, w) for k, j, v, w in new] + [(1000, "new", None, None), (600, "same", 1.0, None)]
    new = [r for r in new if r != (500, "twice", 2.0, None)] + [(500, "twice", 9.0, None)]
    a = ch.take_snapshot(spark.createDataFrame(old, schema), ("k", "j"), depth=depth)
    b = ch.take_snapshot(spark.createDataFrame(new, schema).repartition(5), ("k", "j"), depth=depth)
    got = {(r._change, r.k, r.v) for r in ch.changes(a, b).collect()}
    assert got == {("delete", 3, 3.0), ("delete", 4, 4.0), ("update", 7, 107.0), ("update", 8, 108.0), ("insert", 1000, None),
                   ("update", 500, 9.0), ("insert", 600, 1.0)} and ch.changes(a, b).count() == 7
    assert ch.changes(a, a).count() == 0 and ch.changed_leaves(a, a).count() == 0
    if depth == 2:
        assert 0 < ch.changed_leaves(a, b).count() <= 7
    with pytest.raises(ValueError):
        ch.changed_leaves(a, ch.Snapshot(spark, b.path, b.keys, depth + 1))


def test_only_changed_leaves_are_read(spark):
    table = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    a = ch.take_snapshot(table, ("k",), depth=2)
    b = ch.take_snapshot(table.withColumn("v", F.when(F.col("k") == 77, "y").otherwise(F.col("v"))), ("k",), depth=2)
    assert ch.changed_leaves(a, b).count() == 1
    assert [tuple(r) for r in ch.changes(a, b).collect()] == [("update", 77, "y")]


# ---- labels in time -------------------------------------------------------------------

@pytest.mark.parametrize("size", [100_000, 20])
def test_no_ticket_after_its_label(spark, monkeypatch, size):
    from ebbtide.operators import ordered

    monkeypatch.setattr(ordered, "SLICE_ROWS", size)
    draw = random.Random(size)
    kinds, ranks = ["billing", "technical", "cancellation", "general"], ["low", "high", "critical"]
    tickets = [(i, draw.choice([1, 1, 1, 2, 3]), draw.randrange(50), draw.choice(kinds), draw.choice(ranks), draw.choice([None, 1.5, 4.0])) for i in range(120)]
    labels = [(c, d, n) for n, (c, d) in enumerate([(c, draw.randrange(-3, 55)) for c in (1, 2, 3, 4) for _ in range(6)] + [(1, 10), (1, 10), (2, None)])]
    day = lambda c: F.timestamp_seconds(F.col(c) * 3600).cast("timestamp_ntz")
    t = spark.createDataFrame(tickets, "ticket_id long, customer_id long, d long, category string, priority string, resolution_time_hours double").withColumn(
        "created_date", day("d"))
    ls = spark.createDataFrame(labels, "customer_id long, d long, n long").withColumn("label_date", day("d"))
    got = {r.n: r for r in pit.ticket_features_at(ls, t).collect()}
    assert len(got) == len(labels)
    for c, d, n in labels:
        seen = [x for x in tickets if x[1] == c and d is not None and x[2] < d]
        hours = [x[5] for x in seen if x[5] is not None]
        r = got[n]
        assert (r.total_tickets, r.billing_tickets, r.high_priority_tickets) == (
            len(seen), sum(x[3] == "billing" for x in seen), sum(x[4] != "low" for x in seen))
        assert r.avg_resolution_hours == pytest.approx(np.mean(hours) if hours else 0)
        assert (r.last_ticket_date is None) == (not seen)


# ---- spans ----------------------------------------------------------------------------

def plain_tree(turns):
    """{(conv, turn): (parent, depth, children, spans)} by walking up from every turn."""
    by = defaultdict(dict)
    for c, t, r in turns:
        by[c][t] = min(r, by[c].get(t, r))
    out = {}
    for c, rows in by.items():
        parent = {t: max((s for s, q in rows.items() if s < t and q in sp.ABOVE.get(r, ())), default=None) for t, r in rows.items()}
        for t in rows:
            out[c, t] = [parent[t], 0, sum(p == t for p in parent.values()), 0]
        for t in rows:
            up, d = t, 0
            while up is not None:
                out[c, up][3] += 1
                up, d = parent[up], d + 1
            out[c, t][1] = d - 1
    return {k: tuple(v) for k, v in out.items()}


def test_span_tree(spark):
    draw = random.Random(5)
    turns = [(c, t, draw.choice(["user", "assistant", "system", "tool"])) for c in range(6) for t in range(draw.randrange(1, 25))]
    turns += [(0, 3, "assistant"), (1, 0, "user")]
    df = spark.createDataFrame(turns + [(2, None, "user")], "conv_id long, turn long, role string")
    got = {(r.conv_id, r.turn): (r.parent, r.depth, r.children, r.spans) for r in sp.span_tree(df).collect()}
    assert got == plain_tree(turns)
    assert sp.span_tree(df.limit(0)).count() == 0


def test_a_long_chain_takes_few_rounds(spark):
    n = 20_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"))
    got = sp.span_tree(turns)
    assert got.filter("depth <> turn or spans <> %d - turn" % n).count() == 0 and got.count() == n


# ---- attributions ---------------------------------------------------------------------

def test_attributions_add_up_to_the_margin(spark):
    rows = cm.prepare(sy.synth_customers(sy.keys(spark, 800)))
    rows = rows.drop("name", "gender").cache()
    model = cm.fit_final(rows, {"maxIter": 6, "maxDepth": 4})
    got = at.row_attributions(model, rows)
    sums = got.groupBy("customer_id").agg((F.sum("attribution") + F.max("base")).alias("a"), F.max("margin").alias("b"), F.count("*").alias("n"))
    assert sums.filter("abs(a - b) > 1e-6").count() == 0 and sums.count() == 800
    names = {c for c in dict(cm.importances(model, rows))}
    assert sums.agg(F.max("n")).first()[0] == len(names)
    weight = {r.column_name: r.w for r in got.groupBy("column_name").agg(F.avg(F.abs("attribution")).alias("w")).collect()}
    assert weight["contract_type"] > 0 and set(weight) == names


# ---- documents ------------------------------------------------------------------------

def test_places_of_elements(spark):
    html = ("<!-- x --><title>A &amp; b</title><script>var p = '<p>no</p>';</script><h1>He<b>ad</b></h1>\n<p>one <i>two</i>"
            "<p>three<!-- gone --> four<br>five</p><table><tr><td>1</td></tr></table> tail é &lt;")
    df = spark.createDataFrame([(1, html), (2, ""), (3, None), (4, "<p></p>")], "id long, html string")
    got = {r.id: r.parsed for r in dc.parse_documents(df, "id", "html").collect()}
    elements = got[1].document.elements
    assert [(e.type, e.content) for e in elements] == [("title", "A & b"), ("section_header", "He ad"), ("text", "one two"),
                                                       ("text", "three four five"), ("table", "1"), ("text", "tail é <")]
    for e in elements:
        piece = html[e.start:e.end]
        assert dc.plain_text(dc._inline.sub(" ", dc._hidden.sub("", piece))) == e.content
    assert all(a.end <= b.start for a, b in zip(elements, elements[1:]))
    assert html[elements[0].start:].startswith("<title>") and [got[i].error_status for i in (2, 3, 4)] == ["empty document", "empty document", "no text"]


def test_offsets_go_back():
    import re

    before = "ab<x>cd<x><x>e"
    gone, spaced = dc.Offsets(before, re.compile("<x>"), ""), dc.Offsets(before, re.compile("<x>"), " ")
    assert gone.text == "abcde" and spaced.text == "ab cd  e"
    assert [gone.start(i) for i in range(5)] == [0, 1, 5, 6, 13] and [gone.end(i) for i in range(1, 6)] == [1, 2, 6, 7, 14]
    assert [spaced.start(i) for i in range(8)] == [0, 1, 2, 5, 6, 7, 10, 13] and spaced.end(3) == 5 and spaced.end(2) == 2
