"""What the operators share: shipping to workers, written intermediates, Arrow text buffers."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import shared_dir, without_shuffle_files

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes of text that numpy steps work on at once; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bits of a table of keys: 4 MB, whatever the number of keys. Beyond some ten million of them it only holds back less.
KEY_BITS = 1 << 25


def ensure(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the folder is reachable.

    On a cluster without the folder, pass the package with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    What a finished write has shuffled is of no further use, so Spark removes it at once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    with without_shuffle_files(spark):
        df.write.parquet(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a stored frame that no later step reads."""
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    place = jvm.org.apache.hadoop.fs.Path(df._stored_at)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def carried(df: DataFrame, names: list[str]) -> tuple[Column, list[Column]]:
    """(one struct of a user's columns, by number; the columns out of it again).

    A frame that carries the struct has room for any names of an operator's own.
    """
    user = F.struct(F.lit(0).alias("n"), *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names))).alias("user")
    return user, [F.col(f"user.c{i}").alias(c) for i, c in enumerate(names)]


def marked(df: DataFrame, key: Column, wanted: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """``df`` with a boolean ``may``: false where no row of ``wanted`` has this 64-bit key in its column ``key``.

    A few rows more are true, so a join must follow; but only rows that may meet something take part in it.
    What is broadcast has at most ``bits`` / 64 short rows.
    """
    def bit(slot: str) -> Column:
        return F.expr(f"shiftleft(1L, cast({slot} % 64 as int))")

    slots = wanted.select(F.pmod("key", F.lit(bits)).alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").alias("_word")).agg(F.bit_or(bit("slot")).alias("_bits"))
    asked = df.withColumn("_slot", F.pmod(key, F.lit(bits)))
    met = asked.join(F.broadcast(words), F.expr("_slot div 64") == F.col("_word"), "left")
    may = F.coalesce(F.col("_bits").bitwiseAND(bit("_slot")) != 0, F.lit(False))
    return met.withColumn("may", may).drop("_slot", "_word", "_bits")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one behind the other, and their offsets. Null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(ends):
            base = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
