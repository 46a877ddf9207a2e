"""Token-id files with fixed-width bit packing.

A file set is a folder of Parquet files that Spark writes and reads, so any store will do. Each row is
one packed block: whole documents, in ascending order of their id, in the fewest bits per id that the
vocabulary needs. A block carries the offsets of its documents, so one of them is unpacked without the
rest. ``part`` and ``block`` give the order of all blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.encoder import encoder, vocabulary_path
from ebbtide.llm.runtime import buffers, column, ensure, slices

#: Layout of a block, little-endian: magic, bits, documents, ids; then a null flag (1 byte), id (8) and
#: length (8) for each document, then the packed ids.
HEADER = struct.Struct("<4sIQQ")
MAGIC = b"EBT1"
#: Ids after which a block ends with its document.
BLOCK_IDS = 1 << 18


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids one behind the other, ``bits`` bits each, lowest bit first."""
    wide = np.ascontiguousarray(ids, "<u4")
    if len(wide) and int(wide.max()) >> bits:
        raise ValueError("an id does not fit the width")
    if bits in (8, 16, 32):
        return wide.astype(f"<u{bits // 8}").tobytes()
    cells = np.unpackbits(wide.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(cells.ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """``n`` ids from number ``start`` on; only their own bytes are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n, start * bits // 8).astype("<u4")
    first = start * bits
    cells = np.frombuffer(raw, np.uint8)[first // 8:(first + n * bits + 7) // 8]
    cells = np.unpackbits(cells, bitorder="little")[first % 8:first % 8 + n * bits].reshape(n, bits)
    out = np.zeros((n, 32), np.uint8)
    out[:, :bits] = cells
    return np.packbits(out, axis=1, bitorder="little").view("<u4").ravel()


def write_block(ids: np.ndarray, lengths: np.ndarray, docs: list[int | None], bits: int) -> bytes:
    null = np.array([d is None for d in docs], np.uint8)
    keys = np.array([d or 0 for d in docs], "<i8")
    head = HEADER.pack(MAGIC, bits, len(docs), len(ids))
    return head + null.tobytes() + keys.tobytes() + lengths.astype("<i8").tobytes() + pack(ids, bits)


class Block:
    """A packed block: its documents, their lengths and places, and the ids of any of them."""

    def __init__(self, raw: bytes):
        magic, self.bits, n, self.n_ids = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a block of packed ids")
        at = HEADER.size
        null = np.frombuffer(raw, np.uint8, n, at)
        self.docs = [None if x else d for x, d in zip(null.tolist(), np.frombuffer(raw, "<i8", n, at + n).tolist())]
        self.lengths = np.frombuffer(raw, "<i8", n, at + 9 * n)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.packed = memoryview(raw)[at + 17 * n:]

    def ids(self, k: int | None = None) -> np.ndarray:
        """The ids of document number ``k`` of the block, or of all."""
        if k is None:
            return unpack(self.packed, self.bits, self.n_ids)
        return unpack(self.packed, self.bits, int(self.lengths[k]), int(self.first[k]))


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, doc_id: str = "doc_id",
              text: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, append ``end_id`` and write packed blocks in ascending order of ``doc_id``.

    A null text is empty: its document is the end id alone. Null ids come first; rows with the same id
    follow each other, ordered by a hash of their text, each as a document of its own. An empty table
    gives an empty file set. Other columns are left out.
    """
    spark = ensure(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(vocabulary)
        bits = bits_for(max(machine.library.get_vocab_size(with_added_tokens=True), end_id + 1))
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        count = 0

        def block() -> pa.RecordBatch:
            ids, lengths = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            raw = write_block(ids, lengths, [d for h in held for d in h[2]], bits)
            return pa.RecordBatch.from_pydict({"part": [part], "block": [number], "n_ids": [len(ids)], "packed": [raw]})

        for piece in slices(batches):
            keys = column(piece, "doc_id").to_pylist()
            ids, offsets = machine.encode(*buffers(column(piece, "text")))
            ids = np.insert(ids, offsets[1:], end_id)
            lengths = np.diff(offsets) + 1
            ends, at = np.cumsum(lengths), 0
            while at < len(keys):
                base = ends[at] - lengths[at]
                to = min(len(keys), max(at, int(np.searchsorted(ends, base + block_ids - count))) + 1)
                held.append((ids[base:ends[to - 1]], lengths[at:to], keys[at:to]))
                count += int(ends[to - 1] - base)
                at = to
                if count >= block_ids:
                    yield block()
                    held, count, number = [], 0, number + 1
        if held:
            yield block()

    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order[:2]) \
        .sortWithinPartitions(*order) \
        .mapInArrow(blocks, "part long, block long, n_ids long, packed binary").write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ``start`` counts the ids of all
    documents before it, ``ids`` are little-endian unsigned 32-bit integers."""
    ensure(spark)
    files = spark.read.parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, raw in zip(*(column(batch, c).to_pylist() for c in ("part", "block", "packed"))):
                block = Block(raw)
                ids = block.ids().tobytes()
                at = (block.first * 4).tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(at), pa.int64()), pa.array([number] * len(at), pa.int64()),
                    pa.array(block.docs, pa.int64()), pa.array(block.first), pa.array(block.lengths),
                    pa.array([ids[a:a + 4 * n] for a, n in zip(at, block.lengths.tolist())], pa.binary())],
                    ["part", "block", "doc_id", "first", "n_tokens", "ids"])

    # Two small prefix sums: over the blocks of a part, and over the parts, of which there are as many
    # as the write had partitions.
    inside = files.select("part", "block", F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("b"))
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("p"))
    base = inside.join(parts, "part").select("part", "block", (F.coalesce("b", F.lit(0)) + F.coalesce("p", F.lit(0))).alias("base"))
    read = files.select("part", "block", "packed").mapInArrow(
        documents, "part long, block long, doc_id long, first long, n_tokens long, ids binary")
    return read.join(base, ["part", "block"]).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")
