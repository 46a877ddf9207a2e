"""Writes that later steps read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import shared_dir


def write_overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace the data and schema at a path and return the written copy."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_once(df: DataFrame, label: str) -> DataFrame:
    """Store a costly frame in the shared folder so that later steps reuse it.

    Unlike a cached frame, the written copy outlives lost executors.
    """
    return write_overwrite(df, shared_dir(df.sparkSession, label))


def create_table_as(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE TABLE .. AS SELECT, with the files in the shared folder.

    The new files are complete before the old table goes, so a failed query leaves it as it is.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)


def store_of(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of another, which is kept until the new one stands."""
    store, new = store_of(spark, staged)
    _, old = store_of(spark, path)
    aside = old.suffix("-replaced-" + uuid.uuid4().hex)
    had = store.exists(old)
    if had and not store.rename(old, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not store.rename(new, old):
        if had:
            store.rename(aside, old)
        raise OSError(f"{staged} cannot be moved to {path}")
    if had:
        store.delete(aside, True)


def table_or_else(spark: SparkSession, name: str, stand_in: Callable[[], DataFrame]) -> DataFrame:
    """The named table if it exists, else a computed stand-in."""
    return spark.table(name) if spark.catalog.tableExists(name) else stand_in()


def readiness(assets: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """(asset, rows, status) for each asset; an asset that cannot be read is reported, not raised."""
    found, missing = [], []
    for name, open_asset in assets.items():
        try:
            found.append(open_asset().agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("asset"), "rows", F.lit("ready").alias("status")))
        except Exception:  # unreadable for whatever reason: that is the finding
            missing.append(name)
    if not found:
        raise ValueError("no asset can be read")
    report = found[0]
    for part in found[1:]:
        report = report.unionByName(part)
    for name in missing:
        report = report.unionByName(found[0].limit(1).select(
            F.lit(name).alias("asset"), F.lit(None).cast("bigint").alias("rows"), F.lit("unreadable").alias("status")))
    return report
