"""Packing of token sequences by multiway differencing.

The Karmarkar-Karp method keeps a pool of partial partitions of the documents over ``m`` windows. It
takes the two whose windows are most uneven and merges them with opposing imbalances: the fullest
windows of one with the emptiest of the other, until one partition is left, whose windows are nearly
equal. Each task packs its rows block by block; a block ends when its tokens nearly fill a whole number
of windows, so that little is left to pad.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.encoder import encoder, vocabulary_path
from ebbtide.llm.runtime import buffers, column, ensure, slices

CAPACITY = 2048
#: Windows a block has at least and at most, and the share of a window that may stay empty in between.
LEAST, MOST, SLACK = 48, 192, 0.125


def difference(sizes: list[int], m: int) -> list[list[int]]:
    """``m`` groups of the items with nearly equal sums; ties go to the earlier item."""
    if not sizes:
        return [[] for _ in range(m)]
    # A partial partition lists its non-empty windows, the fullest first: (sum, items).
    pool = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(pool)
    number = len(sizes)
    while len(pool) > 1:
        _, _, a = heapq.heappop(pool)
        _, _, b = heapq.heappop(pool)
        over = len(a) + len(b) - m
        if over <= 0:
            merged = a + b
        else:
            # Windows that both need: the emptiest of a with the fullest of b, and so on crosswise.
            merged = a[:len(a) - over] + b[:len(b) - over] if len(a) < m or len(b) < m else []
            low, high = a[len(a) - over:], b[len(b) - over:]
            merged += [(x + y, [*p, *q]) for (x, p), (y, q) in zip(low, reversed(high))]
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == m else 0)
        heapq.heappush(pool, (-spread, number, merged))
        number += 1
    windows = [items for _, items in pool[0][2]]
    return windows + [[] for _ in range(m - len(windows))]


def fill(sizes: list[int], capacity: int, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length) within the capacity, for items no longer than it.

    With ``cut``, what a window has beyond its capacity is cut off and goes where there is room; the
    number of windows rises only when there is none. Without, it rises until every window fits.
    """
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = difference(sizes, m)
        sums = [sum(sizes[i] for i in g) for g in groups]
        if max(sums) <= capacity:
            return [[(i, 0, sizes[i]) for i in g] for g in groups if g]
        if not cut or sum(sums) > m * capacity:
            m += 1
            continue
        windows, loose = [], []
        for group, total in zip(groups, sums):
            window = [(i, 0, sizes[i]) for i in group]
            while total > capacity:
                i, start, length = window.pop()
                keep = max(0, length - (total - capacity))
                if keep:
                    window.append((i, start, keep))
                loose.append((i, start + keep, length - keep))
                total -= length - keep
            windows.append((total, window))
        loose.sort(key=lambda p: -p[2])
        for total, window in sorted(windows, key=lambda w: -w[0]):
            while loose and total < capacity:
                i, start, length = loose.pop(0)
                take = min(length, capacity - total)
                window.append((i, start, take))
                if take < length:
                    loose.insert(0, (i, start + take, length - take))
                total += take
        return [w for _, w in windows if w]


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 1,
                   doc_id: str = "doc_id", text: str = "text", cut: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    Returns (doc_id, start, length, doc_tokens, sequence_id, offset, ids): ``length`` ids of the
    document from ``start`` on stand at ``offset`` of the sequence; ``ids`` are little-endian unsigned
    32-bit integers. Each document ends with ``end_id``; a null or empty text is that id alone. A
    document longer than a sequence fills sequences of its own first. Rows with the same or a null id
    are documents of their own. Sequences are to be padded to the capacity. Other columns are left out;
    an empty table gives no rows. Results depend on how rows lie in partitions, not on timing.
    """
    ensure(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 40
        rests: list[tuple] = []  # (doc id, ids, start of the rest)
        total = 0
        out: list[tuple] = []

        def put(key, ids, start, length, number, offset):
            out.append((key, start, length, len(ids), number, offset, ids[start:start + length].tobytes()))

        def block():
            nonlocal rests, total, sequence
            for window in fill([len(ids) - start for _, ids, start in rests], capacity, cut):
                offset = 0
                for i, start, length in window:
                    key, ids, base = rests[i]
                    put(key, ids, base + start, length, sequence, offset)
                    offset += length
                sequence += 1
            rests, total = [], 0

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                               for n, c in zip(names, zip(*out))], names)
            out.clear()
            return made

        for piece in slices(batches):
            keys = column(piece, "doc_id").to_pylist()
            flat, offsets = machine.encode(*buffers(column(piece, "text")))
            flat = np.insert(flat, offsets[1:], end_id).astype("<u4")
            edges = (offsets + np.arange(len(offsets))).tolist()
            for key, a, b in zip(keys, edges[:-1], edges[1:]):
                ids, start = flat[a:b], 0
                while len(ids) - start >= capacity:
                    put(key, ids, start, capacity, sequence, 0)
                    sequence += 1
                    start += capacity
                if start < len(ids):
                    rests.append((key, ids, start))
                    total += len(ids) - start
                    if total >= LEAST * capacity and (-total % capacity <= SLACK * capacity or total >= MOST * capacity):
                        block()
            rests = [(key, ids.copy(), start) for key, ids, start in rests]  # let go of the slice
            if out:
                yield flush()
        if rests:
            block()
            yield flush()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(pack, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
