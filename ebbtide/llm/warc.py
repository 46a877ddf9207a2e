"""WARC archives, written and read back by many tasks.

Writing: pages with equal payloads are found by digest, one stays a response and the others become
revisit records. Reading: each task looks for the record magic in its own byte range and follows every
candidate to its successor, record length by record length, until it leaves the range. These
candidate-to-successor pairs form chains; pointer jumping from the start of each file finds where the true
chain enters each range, which rejects magic that only stands inside a payload. A last pass reads the
records from those entries.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.runtime import column, ensure, slices, stored

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a task begins a new archive; bytes a reading task scans; most bytes of a record's head.
ARCHIVE, RANGE, HEAD = 64 << 20, 8 << 20, 1 << 20
#: Ranges that a reading task takes at most, where there are many.
RANGES = 16


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store: one without a scheme is in the cluster's default store, not on each task's own disk."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The store of a path and the path in it; any store Arrow knows (local, HDFS, S3, GCS)."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None) -> bytes:
    """One record; ``response`` is the page that a revisit refers to."""
    key = "" if page_id is None else page_id
    lines = [f"WARC-Type: {'response' if response is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{key}>",
             "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {len(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if response is not None:
        lines += [f"WARC-Refers-To: <urn:page:{response}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return MAGIC + "\r\n".join(lines).encode() + END + payload + END


def parse_head(head: bytes) -> dict[str, str] | None:
    """The fields of a record's head, or None if it is none."""
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdecimal() else None


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` with digest (hex SHA-1 of the UTF-8 payload) and response_id, set where the page revisits another."""
    rows = pages.withColumn("payload", F.coalesce("html", F.lit(""))).withColumn("digest", F.sha1("payload"))
    groups = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored first, so that its size is known: a small table is broadcast, a large one joined by shuffle.
    rows = rows.join(stored(groups, "warc-groups"), "digest", "left")
    own = F.col("page_id").isNotNull() & (F.col("page_id") == F.col("response_id"))
    return rows.withColumn("response_id", F.when(~own, F.col("response_id")))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write a record for each page (page_id, url, html) into archives under ``path``; returns (file, bytes).

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the largest page_id is
    a response and the others revisit it; where repeated rows share that id, each is a response. A null
    html is an empty payload. A null id revisits if an id is known for its payload, else it is a
    response. Other columns are left out; an empty table gives no archive. A file gets its name only when
    it is complete, so a repeated task replaces it as a whole.
    """
    path = qualified(ensure(pages.sparkSession), path)
    rows = decide(pages.select("page_id", "url", "html"), least_bytes).select("page_id", "url", "payload", "digest", "response_id")
    names = rows.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        store.create_dir(folder, recursive=True)
        part, number, out, held = TaskContext.get().partitionId(), 0, None, 0
        done: list[tuple[str, int]] = []

        def close():
            nonlocal out, number, held
            out.close()
            name = f"{part:06d}-{number:04d}.warc"
            store.move(hidden, f"{folder}/{name}")
            done.append((name, held))
            out, number, held = None, number + 1, 0

        for piece in slices(batches, "payload"):
            for page, url, payload, digest, response in zip(*(column(piece, c).to_pylist() for c in names)):
                if out is None:
                    hidden = f"{folder}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(hidden)
                raw = record(page, url, payload.encode(), base32(digest), response)
                out.write(raw)
                held += len(raw)
                if held >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([s for _, s in done], pa.int64())], ["file", "bytes"])

    return stored(rows.mapInArrow(write, "file string, bytes long"), "warc-files")


def read_archives(archives: DataFrame, path: str, range_bytes: int = RANGE) -> DataFrame:
    """The records of the archives (file, bytes): page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Bytes and digest of a response are those of the payload read; a revisit has them from its head.
    """
    spark = ensure(archives.sparkSession)
    path = qualified(spark, path)
    ranges = archives.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    # The rows are tiny and stand for whole ranges, so their number sets the tasks, not their bytes.
    n_ranges = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    tasks = int(max(min(2 * n_ranges, 3 * spark.sparkContext.defaultParallelism), -(-n_ranges // RANGES)))
    ranges = ranges.repartition(tasks, "file", "start")

    def head_at(source, at: int, size: int, data: bytes, base: int) -> tuple[dict, int] | None:
        """(fields, offset of the payload) of the record at an offset; ``data`` holds the file from ``base`` on."""
        end = data.find(END, at - base)
        if end < 0 or end - (at - base) > HEAD:
            source.seek(at)
            data, base = source.read(min(HEAD, size - at)), at
            end = data.find(END)
            if end < 0:
                return None
        fields = parse_head(data[at - base:end])
        return None if fields is None else (fields, base + end + len(END))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        for batch in batches:
            for file, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                stop = min(size, start + range_bytes)
                with store.open_input_file(f"{folder}/{file}") as source:
                    source.seek(start)
                    data = source.read(min(size, stop + len(MAGIC)) - start)
                    found = [m.start() + start for m in re.finditer(b"(?=" + re.escape(MAGIC) + b")", data) if m.start() + start < stop]
                    leaves: dict[int, int] = {}
                    for at in reversed(found):  # successors lie behind, so their way out is known
                        head = head_at(source, at, size, data, start)
                        if head is not None:
                            to = head[1] + int(head[0]["content-length"]) + len(END)
                            if to >= stop:
                                leaves[at] = to
                            elif to in leaves:
                                leaves[at] = leaves[to]
                yield pa.RecordBatch.from_arrays([
                    pa.array([file] * len(leaves), pa.string()), pa.array(list(leaves), pa.int64()),
                    pa.array(list(leaves.values()), pa.int64())], ["file", "at", "to"])

    jumps = stored(ranges.mapInArrow(follow, "file string, at long, to long"), "warc-jumps")
    entered = archives.where("bytes > 0").select("file", F.lit(0).cast("long").alias("at"))
    most = archives.agg(F.max("bytes").alias("b")).first()["b"] or 0
    reach = 1  # ranges that one jump may cross
    while True:
        onward = entered.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        entered = stored(entered.union(onward).distinct(), "warc-entered")
        if reach * range_bytes >= most:
            break
        further = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("end"))
        jumps = stored(jumps.join(further, ["file", "to"], "left").select(
            "file", "at", F.coalesce("end", "to").alias("to")), "warc-jumps")
        reach *= 2
    begin = F.floor(F.col("at") / range_bytes).cast("long") * range_bytes
    entries = entered.join(archives, "file").where("at < bytes").select("file", "bytes", begin.alias("start"), "at")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        for batch in batches:
            for file, size, start, at in zip(*(c.to_pylist() for c in batch.columns)):
                stop, out, held = min(size, start + range_bytes), [], 0
                with store.open_input_file(f"{folder}/{file}") as source:
                    source.seek(at)
                    data, base = source.read(stop - at), at
                    while at < stop:
                        head = head_at(source, at, size, data, base)
                        if head is None:
                            raise ValueError(f"{file}: no record at {at}")
                        fields, body = head
                        length = int(fields["content-length"])
                        at = body + length + len(END)
                        if at > size:
                            raise ValueError(f"{file}: cut off")
                        if body + length <= base + len(data):
                            payload = data[body - base:body - base + length]
                        else:
                            source.seek(body)
                            payload = source.read(length)
                        page, refers = (re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(f, ""))
                                        for f in ("warc-record-id", "warc-refers-to"))
                        digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                        if kind == "response":
                            size_of, own = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if own != digest:
                                raise ValueError(f"{file}: a payload does not have its digest")
                        else:
                            size_of = int(fields["payload-length"])
                        out.append((int(page[1]) if page and page[1] else None, fields.get("warc-target-uri"), payload, size_of, digest,
                                    kind, int(refers[1]) if refers else None))
                        held += length
                        if held >= range_bytes:
                            yield made(out)
                            out, held = [], 0
                if out:
                    yield made(out)

    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return entries.repartition(tasks, "file", "start").mapInArrow(
        records, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")
