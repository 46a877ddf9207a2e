"""Streaming queries: each runs to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import sketches as sk
from ebbtide.plans.oracle import VIEWS
from ebbtide.plans.registry import query
from ebbtide.session import shared_dir
from ebbtide.streaming import changes as ch
from ebbtide.streaming import profile as sp
from ebbtide.streaming import sync as ss
from ebbtide.streaming import windows as wd


def _synced(t):
    target = shared_dir(t.spark, "synced")
    stream = ss.file_stream(t.spark, t.root, "documents")
    ss.sync(stream, "doc_id", target, shared_dir(t.spark, "sync-checkpoint"),
            lambda batch: ss.embed(batch.select("doc_id", "lang", "text")).drop("text"))
    return ss.latest(t.spark, target, "doc_id")


@query("stream_sync", "select doc_id, lang, 256 as width from documents")
def stream_sync(t):
    return _synced(t).select("doc_id", "lang", F.size("vector").alias("width"))


@query("incremental_sync", """select doc_id, case when doc_id % 5 = 1 then upper(lang) else lang end as lang, 256 as width
 from documents where doc_id % 7 <> 3""")
def incremental_sync(t):
    """Upkeep in two runs on one checkpoint: the first takes most of the table, the second finds rows that
    were added, changed (their language in capitals) and deleted. The target is then compacted."""
    source, target, checkpoint = (shared_dir(t.spark, n) for n in ("source", "synced", "sync-checkpoint"))
    docs = t.raw("documents").select("doc_id", "lang", "text").withColumn(ss.DELETED, F.lit(False))

    def run(changes, folder):
        changes.write.parquet(f"{source}/{folder}")
        stream = t.spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(source)
        ss.sync(stream, "doc_id", target, checkpoint, lambda batch: ss.embed(batch).drop("text"))

    run(docs.filter("doc_id % 3 <> 0"), "first")
    added = docs.filter("doc_id % 3 = 0 and doc_id % 5 <> 1 and doc_id % 7 <> 3")
    changed = docs.filter("doc_id % 5 = 1 and doc_id % 7 <> 3").withColumn("lang", F.upper("lang"))
    gone = docs.filter("doc_id % 7 = 3").withColumn(ss.DELETED, F.lit(True))
    run(added.union(changed).union(gone), "second")
    ss.compact(t.spark, target, "doc_id")
    return ss.latest(t.spark, target, "doc_id").select("doc_id", "lang", F.size("vector").alias("width"))


@query("stream_profile", """with w as (select date_trunc('day', ts)::timestamp as window_start, event_type, count(*) as count,
  round(avg(value), 6) as avg, min(value) as min, max(value) as max from events group by all)
 select window_start, event_type, count, avg, min, max from w""")
def stream_profile(t):
    path = shared_dir(t.spark, "profile")
    stream = sp.windowed_profile(ss.file_stream(t.spark, t.root, "events"), "ts", "event_type", "value")
    sp.run_to_table(stream, path, shared_dir(t.spark, "profile-checkpoint"))
    profile = sp.windowed_profile(t.raw("events"), "ts", "event_type", "value")
    out = sp.with_open_windows(t.spark.read.schema(profile.schema).parquet(path), profile)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "count",
                      F.round("avg", 6).alias("avg"), "min", "max")


_DAY = 86_400_000

# Rows come in three runs; a window is closed for a run by the newest time of those before it, less a day.
VIEWS["event_runs"] = """select *, event_id % 3 as run, date_trunc('day', ts) as start from events"""
VIEWS["run_marks"] = """select r.run, (select date_trunc('milliseconds', max(ts)) from event_runs e where e.run < r.run) - interval 1 day as passed
 from (select distinct run from event_runs) r"""


@query("stream_windows", """with placed as (select e.*, coalesce(start + interval 1 day <= passed, false) as late from event_runs e join run_marks using (run)),
 done as (select date_trunc('milliseconds', max(ts)) - interval 1 day as passed from events)
 select case when late then 'late' when start + interval 1 day <= (select passed from done) then 'closed' else 'open' end as kind,
 event_type, start::timestamp as window_start, count(*) as count, round(avg(value), 6) as avg, min(value) as min, max(value) as max
 from placed group by all""")
def stream_windows(t):
    """Three runs on one checkpoint: windows closed by timers, rows that came too late, and windows open at the end."""
    source, path, checkpoint = (shared_dir(t.spark, n) for n in ("event-runs", "windows", "windows-checkpoint"))
    events = t.raw("events")
    for run in range(3):
        events.filter(F.col("event_id") % 3 == run).write.mode("append").parquet(f"{source}/run={run}")
        stream = t.spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(source)
        wd.run_windows(wd.windowed(stream, "ts", "event_type", "value", _DAY, "1 day"), path, checkpoint)
    out = wd.read_windows(t.spark, path, checkpoint)
    return out.select("kind", F.col("by").alias("event_type"), F.col("window_start").cast("timestamp_ntz").alias("window_start"), "count",
                      F.round("avg", 6).alias("avg"), "min", "max")


@query("profile_refresh", """select event_type, 'value' as column_name, count(value) as count, round(avg(value), 6) as avg,
 round(stddev_samp(value), 6) as stddev, min(value) as min, max(value) as max, true as distinct_close, true as quantiles_close
 from events group by 1""")
def profile_refresh(t):
    """A profile kept by sketches over two refreshes, the second of which reads only the files that came since; errors against the exact values."""
    source, path, checkpoint = (shared_dir(t.spark, n) for n in ("profile-source", "profile-state", "profile-checkpoint"))
    events = t.raw("events")
    for run in range(2):
        events.filter(F.col("event_id") % 2 == run).write.mode("append").parquet(f"{source}/run={run}")
        stream = t.spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(source)
        sk.refresh(stream, path, checkpoint, ["event_type"], ["value"])
    got = sk.read_profile(sk.state_of(t.spark, path), ["event_type"])
    named = {q: F.col(q) for q in sk.QUANTILES}
    ranks = events.join(got.select("event_type", *[c.alias(f"_{q}") for q, c in named.items()]), "event_type").groupBy("event_type").agg(
        F.count_distinct("value").alias("_distinct"),
        *[F.avg((F.col("value") < F.col(f"_{q}")).cast("double")).alias(f"_below_{q}") for q in sk.QUANTILES],
        *[F.avg((F.col("value") <= F.col(f"_{q}")).cast("double")).alias(f"_upto_{q}") for q in sk.QUANTILES])
    room = 2 * sk.RANK_ERROR
    close = [(F.col(f"_below_{q}") <= p + room) & (F.col(f"_upto_{q}") >= p - room) for q, p in sk.QUANTILES.items()]
    return got.join(ranks, "event_type").select(
        "event_type", "column_name", "count", F.round("avg", 6).alias("avg"), F.round("stddev", 6).alias("stddev"), "min", "max",
        (F.abs(F.col("distinct_count") - F.col("_distinct")) <= 4 * sk.DISTINCT_ERROR * F.col("_distinct") + 1).alias("distinct_close"),
        (close[0] & close[1] & close[2]).alias("quantiles_close"))


@query("snapshot_changes", """select case when doc_id % 83 = 0 then 'insert' when doc_id % 89 = 0 then 'delete' else 'update' end as _change, doc_id,
 case when doc_id % 97 = 0 and doc_id % 83 <> 0 and doc_id % 89 <> 0 then upper(lang) else lang end as lang, n_chars from documents
 where doc_id % 83 = 0 or doc_id % 89 = 0 or doc_id % 97 = 0""")
def snapshot_changes(t):
    """Inserts, changes and deletes between two plain copies of a table, of which nobody kept a record."""
    docs = t.raw("documents").select("doc_id", "lang", "source", "n_chars")
    old = docs.filter("doc_id % 83 <> 0")
    new = docs.filter("doc_id % 83 = 0 or doc_id % 89 <> 0").withColumn(
        "lang", F.when(F.expr("doc_id % 97 = 0 and doc_id % 83 <> 0"), F.upper("lang")).otherwise(F.col("lang")))
    first = ch.take_snapshot(old, ("doc_id",), depth=ch.depth_for(docs.count(), 64))
    second = ch.take_snapshot(new, ("doc_id",), depth=first.depth)
    return ch.changes(first, second).select("_change", "doc_id", "lang", "n_chars")
