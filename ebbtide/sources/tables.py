"""Scans of the stored tables and their retention-shaped views."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.hashing import uniform
from ebbtide.schemas import schema_of
from ebbtide.sources.sinks import materialize_once


def scan_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet scan with a declared schema: no inference job, pruned and pushed down."""
    return spark.read.schema(schema_of(name)).parquet(os.path.join(root, f"{name}.parquet"))


def scan_by_identifier(spark: SparkSession, *parts: str) -> DataFrame:
    """Read a catalog object whose dotted name is put together at run time."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": ".".join(p for p in parts if p)})


#: Bytes of a file that is one value; a larger one is read in lines, each a value of its own.
WHOLE_BYTES = 64 << 20
#: Endings by which Spark's readers of lines would unpack a file.
PACKED = r"[.](gz|bz2|deflate|snappy|lz4|zst)$"
#: Large files of one job.
FILES_AT_ONCE = 32
_MARK = b"\xef\xbb\xbf"


def scan_binary_files(spark: SparkSession, folder: str, glob: str = "*", content: bool = False) -> DataFrame:
    """One row per file, those in folders below too. The file bytes are read only when ``content`` is asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", "content") if content else files.select("path", "length")


def file_digests(files: DataFrame) -> DataFrame:
    """path, length, content_length, content_md5 of the rows of ``scan_binary_files`` with content.

    A value holds two gigabytes at most, and a few copies of it are in memory. So only files of up to ``WHOLE_BYTES``,
    and those whose ending would have them unpacked, are read as one value. Of each larger one, a single task reads
    all lines in their order and hands their bytes on to the digest; no more than a batch of them is held.
    """
    spark = files.sparkSession
    out = _whole_digests(files.filter(F.col("length") <= WHOLE_BYTES))  # alone, so that the scan skips the others
    large = [(r.path, r.length) for r in files.filter(F.col("length") > WHOLE_BYTES).select("path", "length").collect()]
    packed = [_literal(path) for path, _ in large if re.search(PACKED, path.lower())]
    if packed:
        out = out.unionByName(_whole_digests(spark.read.format("binaryFile").load(packed)))
    large = [x for x in large if not re.search(PACKED, x[0].lower())]
    for at in range(0, len(large), FILES_AT_ONCE):
        some = [_digest(spark, path, length) for path, length in large[at:at + FILES_AT_ONCE]]
        out = out.unionByName(materialize_once(reduce(DataFrame.unionByName, some), "file-digests"))
    return out


def _whole_digests(files: DataFrame) -> DataFrame:
    return files.select(
        "path", "length", F.octet_length("content").cast("bigint").alias("content_length"), F.md5("content").alias("content_md5"))


def _literal(path: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _digest(spark: SparkSession, path: str, length: int) -> DataFrame:
    """One row for one file. Its splits are equal but for the last, so they stand in order, and one task reads them all."""
    lines = spark.read.option("lineSep", "\n").text(_literal(path)).select(
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("bytes"), F.col("_metadata.file_block_start").alias("start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A mark of the byte order at a file's start is not handed on; its absence shows at the end.
        plain, marked = hashlib.md5(), hashlib.md5(_MARK)
        total, start, held = 0, -1, b""
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = batch.column(1).to_numpy()
            if starts[0] < start or (starts[1:] < starts[:-1]).any():
                raise ValueError(f"{path} was not read in order")
            start = starts[-1]
            column = batch.column(0).cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            data = memoryview(column.buffers()[2])[offsets[0]:offsets[-1]]
            for digest in (plain, marked):
                digest.update(held)
                digest.update(data[:-1])
            held, total = b"\n", total + len(data)
        missing = length - total
        if missing in (0, len(_MARK)) and held:  # a line break is the last byte
            plain.update(held)
            marked.update(held)
        elif missing not in (-1, len(_MARK) - 1):
            raise OSError(f"{path} has {length} bytes, {total} were read")
        digest = marked if missing in (len(_MARK), len(_MARK) - 1) else plain
        yield pa.RecordBatch.from_pydict({"path": [path], "length": [length], "content_length": [length], "content_md5": [digest.hexdigest()]})

    return lines.coalesce(1).mapInArrow(work, "path string, length bigint, content_length bigint, content_md5 string")


def customers_view(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers in retention shape; a customer churned if the last order is old."""
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    no_internet = F.col("c_nationkey") % 3 == 2

    def pick(tag: str, p: float):
        return F.when(uniform("c_custkey", tag) < p, "Yes").otherwise("No")

    def service(tag: str, p: float):
        return (
            F.when(no_internet, "No internet service")
            .when(uniform("c_custkey", tag) < p, "Yes")
            .otherwise("No")
        )

    monthly = F.lit(2000) + F.floor(F.abs("c_acctbal"))
    tenure = ((F.col("c_custkey") * 7 + F.col("c_nationkey")) % 73).cast("bigint")
    return customer.join(last, customer.c_custkey == last.o_custkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(uniform("c_custkey", "senior") < 0.16, 1).otherwise(0).alias("senior_citizen"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Month-to-month")
        .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "One year")
        .otherwise("Two year").alias("contract_type"),
        F.when(F.col("c_nationkey") % 3 == 0, "Fiber optic")
        .when(F.col("c_nationkey") % 3 == 1, "DSL")
        .otherwise("No").alias("internet_service"),
        F.when(F.col("c_custkey") % 4 == 0, "Electronic check")
        .when(F.col("c_custkey") % 4 == 1, "Mailed check")
        .when(F.col("c_custkey") % 4 == 2, "Bank transfer")
        .otherwise("Credit card").alias("payment_method"),
        pick("phone", 0.9).alias("phone_service"),
        pick("paper", 0.6).alias("paperless_billing"),
        pick("partner", 0.5).alias("partner"),
        pick("dep", 0.3).alias("dependents"),
        service("stv", 0.5).alias("streaming_tv"),
        service("smo", 0.5).alias("streaming_movies"),
        service("sec", 0.35).alias("online_security"),
        service("bak", 0.4).alias("online_backup"),
        service("dev", 0.4).alias("device_protection"),
        service("tec", 0.35).alias("tech_support"),
        tenure.alias("tenure_months"),
        (monthly.cast("double") / 100).alias("monthly_charges"),
        ((monthly * tenure).cast("double") / 100).alias("total_charges"),
        F.when(F.col("last_order") < F.lit("2000-08-01 00:00:00").cast("timestamp_ntz"), "Yes")
        .otherwise("No").alias("churn"),
    )


def tickets_view(events: DataFrame) -> DataFrame:
    """Service tickets in retention shape."""
    e = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select(
        F.col("event_id").alias("ticket_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("created_date"),
        F.when(F.col("event_type") == "purchase", "billing")
        .when(F.col("event_type") == "error", "technical")
        .when(F.col("event_type") == "click", "cancellation")
        .when(F.col("event_type") == "signup", "upgrade")
        .otherwise("general").alias("category"),
        F.when(F.col("k") < 30, "low").when(F.col("k") < 70, "medium")
        .when(F.col("k") < 90, "high").otherwise("critical").alias("priority"),
        F.when(F.col("k") % 20 < 3, "open").when(F.col("k") % 20 < 16, "resolved")
        .otherwise("escalated").alias("status"),
        F.when((F.col("k") % 20 >= 3) & (F.col("k") % 20 < 16), F.round("value", 1)).alias("resolution_time_hours"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("description"),
    )


def churn_labels_view(customers: DataFrame) -> DataFrame:
    """Label table; the 70/15/15 split is a column drawn per customer."""
    u = uniform("customer_id", "split")
    return customers.select(
        "customer_id", "churn",
        F.lit("2025-06-01 00:00:00").cast("timestamp_ntz").alias("label_date"),
        F.when(u < 0.70, "train").when(u < 0.85, "val").otherwise("test").alias("split"),
    )


class Tables:
    """The stored tables under one folder, and the retention views over them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._made: dict[str, DataFrame] = {}

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Make a derived frame on first use and keep it for this object's life."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def raw(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.root, name)

    @cached_property
    def customers(self) -> DataFrame:
        return customers_view(self.raw("customer"), self.raw("orders"))

    @cached_property
    def tickets(self) -> DataFrame:
        return tickets_view(self.raw("events"))

    @cached_property
    def churn_labels(self) -> DataFrame:
        return churn_labels_view(self.customers)

    def views(self) -> None:
        """Register the retention tables for SQL callers."""
        self.customers.createOrReplaceTempView("customers")
        self.tickets.createOrReplaceTempView("service_tickets")
        self.churn_labels.createOrReplaceTempView("churn_labels")
