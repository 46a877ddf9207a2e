"""Incremental upkeep of a derived table from changed source rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.search import words
from ebbtide.schemas import schema_of
from ebbtide.sources.sinks import store_of, swap_in

#: A derived row with this column set removes its key.
DELETED = "_deleted"


def embed(articles: DataFrame, text: str = "text", size: int = 256) -> DataFrame:
    """Add a unit-length hashed term vector; needs no fit, so old and new rows agree."""
    counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=size).transform(
        articles.withColumn("_words", words(F.col(text))))
    unit = Normalizer(inputCol="_tf", outputCol="_unit").transform(counted)
    return unit.withColumn("vector", vector_to_array("_unit", "float32")).drop("_words", "_tf", "_unit")


def file_stream(spark: SparkSession, root: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over a stored table, which may be one file or a folder of part files; none at all is an error."""
    reader = spark.readStream.schema(schema_of(name))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    store, place = store_of(spark, os.path.join(root, f"{name}.parquet"))
    if store.exists(place) and store.getFileStatus(place).isDirectory():
        return reader.parquet(place.toString())
    if not store.globStatus(store_of(spark, os.path.join(root, f"{name}*.parquet"))[1]):
        raise FileNotFoundError(f"no file or folder of {name} under {root}")
    return reader.option("pathGlobFilter", f"{name}*.parquet").parquet(root)


def sync(stream: DataFrame, key: str, target: str, checkpoint: str, derive: Callable[[DataFrame], DataFrame]) -> None:
    """Bring the target up to date with everything new in the stream, then stop.

    Each micro-batch writes its derived rows to a folder named by its batch id, and
    overwrites that folder when a failed batch is run again, so a repeat changes
    nothing. Readers take the newest row of each key (``latest``).
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        derive(batch).write.mode("overwrite").parquet(os.path.join(target, f"batch={batch_id}"))

    query = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def latest(spark: SparkSession, target: str, key: str, order: str | None = None) -> DataFrame:
    """The current rows: per key the row of the newest batch, reduced on the map side."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    by = F.struct(F.col("batch"), *([F.col(order)] if order else []))
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(key, "_row.*")
    return newest.filter(f"not coalesce({DELETED}, false)").drop(DELETED) if DELETED in rest else newest


def compact(spark: SparkSession, target: str, key: str, order: str | None = None) -> None:
    """Replace all batches by one that holds the current rows, under the number of the newest.

    Batches written later have higher numbers, so the upkeep goes on as before.
    """
    newest = spark.read.parquet(target).agg(F.max("batch")).first()[0]
    staged = f"{target.rstrip('/')}-compact-{uuid.uuid4().hex}"
    latest(spark, target, key, order).write.parquet(os.path.join(staged, f"batch={newest}"))
    swap_in(spark, staged, target)
