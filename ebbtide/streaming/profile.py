"""The windowed profile kept up by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_profile(
    events: DataFrame, timestamp: str, by: str, value: str, length: str = "1 day", lateness: str = "1 day"
) -> DataFrame:
    """Statistics per window and group over a stream or a table of events.

    The state holds one aggregate per open window and group, never rows. In append mode
    a window comes out once the watermark has passed its end.
    """
    timed = events.withColumn("_at", F.col(timestamp).cast("timestamp")).withWatermark("_at", lateness)
    return timed.groupBy(F.window("_at", length), by).agg(
        F.count("*").alias("count"), F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.sum(F.when(F.col(value).isNull(), 1).otherwise(0)).alias("nulls"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             by, "count", "avg", "min", "max", "nulls")


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what the stream can finish now to a parquet table, then stop."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def with_open_windows(closed: DataFrame, profile: DataFrame) -> DataFrame:
    """The windows that came out of a stream, and those it still held open, from the profile of the same table.

    Windows come out in order of their ends, so the open ones end after all that came out; only their
    events are aggregated again.
    """
    newest = closed.agg(F.max("window_end")).first()[0]
    still_open = profile if newest is None else profile.filter(F.col("window_end") > F.lit(newest))
    return closed.unionByName(still_open)
