"""Event-time windows kept as arbitrary state, with timers that close them and late rows told apart.

A built-in windowed aggregate drops rows that come after their window has closed and says little about them. Here a
stateful processor holds one total for each open window of a group. A timer at the window's end brings it out once the
watermark has passed it; what comes later is brought out as late, counted exactly, and never changes a closed window.
The windows that are still open when a run ends are read from the state itself, so closed, open and late rows together
are all rows that came.

Rows are added up by window before they reach the state, on the map side, so a group with a third of all rows sends a
few totals for each task. The number of open windows bounds the state, not the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTING = "spark.sql.streaming.stateStore.providerClass"
TOTAL = "count long, total double, least double, most double, nulls long"
OUT = f"kind string, by string, start long, {TOTAL}"  # start: milliseconds
CLOSED, LATE = "closed", "late"


def _combined(old: tuple | None, new: tuple) -> tuple:
    if old is None:
        return new
    pick = lambda f, a, b: b if a is None else a if b is None else f(a, b)
    return (old[0] + new[0], pick(lambda a, b: a + b, old[1], new[1]), pick(min, old[2], new[2]), pick(max, old[3], new[3]), old[4] + new[4])


def _plain(x):
    return None if pd.isna(x) else float(x)


class _Windows(StatefulProcessor):
    """Totals of the open windows of one group."""

    def __init__(self, length_ms: int):
        self.length_ms = length_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", TOTAL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        late = []
        for batch in rows:
            for start, *total in zip(*(batch[c].tolist() for c in ("start", "count", "total", "least", "most", "nulls"))):
                new = (int(total[0]), *map(_plain, total[1:4]), int(total[4]))
                if start + self.length_ms <= passed:
                    late.append((LATE, key[0], start, *new))
                    continue
                old = self.open.getValue((start,)) if self.open.containsKey((start,)) else None
                self.open.updateValue((start,), _combined(old, new))
                if old is None:
                    self.handle.registerTimer(start + self.length_ms)
        yield self._frame(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.length_ms
        total = self.open.getValue((start,))
        self.open.removeKey((start,))
        yield self._frame([(CLOSED, key[0], start, *total)])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["kind", "by", "start", "count", "total", "least", "most", "nulls"])
        return out.astype({"start": "int64", "count": "int64", "nulls": "int64", "total": "float64", "least": "float64", "most": "float64"})

    def close(self) -> None:
        pass


def _totals(events: DataFrame, length_ms: int) -> DataFrame:
    """by, start, totals: the rows of each Arrow batch added up by window."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["start"] = batch["ms"] // length_ms * length_ms
            value = batch.groupby(["by", "start"], dropna=False, sort=False)["value"]
            out = pd.DataFrame({"count": value.size(), "total": value.sum(min_count=1), "least": value.min(), "most": value.max()})
            out["nulls"] = out["count"] - value.count()
            yield out.reset_index()[["by", "start", "count", "total", "least", "most", "nulls"]]

    return events.mapInPandas(add, f"by string, start long, {TOTAL}")


def windowed(events: DataFrame, timestamp: str, by: str, value: str, length_ms: int, lateness: str) -> DataFrame:
    """The stream of closed windows and late totals. Rows without a time belong to no window and are left out."""
    timed = events.select(F.col(timestamp).cast("timestamp").alias("at"), F.col(by).cast("string").alias("by"),
                          F.col(value).cast("double").alias("value")).filter("at is not null").withWatermark("at", lateness)
    rows = timed.select("by", "value", F.unix_millis("at").alias("ms"))
    return _totals(rows, length_ms).groupBy("by").transformWithStateInPandas(
        _Windows(length_ms), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def run_windows(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append closed windows and late totals to a table at ``path`` until the source has nothing new.

    A batch that is run again replaces its own folder.
    """
    spark = stream.sparkSession
    before = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, PROVIDER)
    try:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

        query = stream.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    finally:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """by, start, totals of the windows that a run has left open, from its state."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.select(F.col("key.by").alias("by"), F.col("user_map_key.start").alias("start"), "user_map_value.*")


def read_windows(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """kind (closed, open, late), by, window_start, count, avg, min, max, nulls.

    A window may have several late rows, one for each batch and task that brought some; they are added up.
    """
    written = spark.read.schema(OUT).parquet(path).drop("batch")  # the folder a row came from
    every = written.unionByName(open_windows(spark, checkpoint).withColumn("kind", F.lit("open")))
    out = every.groupBy("kind", "by", "start").agg(
        F.sum("count").alias("count"), F.sum("total").alias("total"), F.min("least").alias("min"), F.max("most").alias("max"),
        F.sum("nulls").alias("nulls"))
    valued = F.col("count") - F.col("nulls")
    return out.select("kind", "by", F.timestamp_millis("start").alias("window_start"), "count",
                      F.when(valued > 0, F.col("total") / valued).alias("avg"), "min", "max", "nulls")
