"""Exact top-k by inner product with an impact-ordered index, score at a time.

Each task holds an index over a block of vectors: for every component the vectors in order of their value,
so that the impact of a posting, query weight times value, falls along the list in one direction or the
other. Impacts are quantised into levels, and the segments of all lists are processed level by level, the
highest first. What a vector has not yet been given is bounded: by the level for lists that were begun, by
a list's best impact for the others. The search stops only when this proves which vectors can still be
among the best, those whose bound reaches the k-th best exact score known; they are scored again exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.runtime import column, discard, ensure, quoted, stored

#: Queries that one pass sends to all tasks, vectors an index block holds, and the levels as shares of the highest impact.
QUERIES, BLOCK, LEVELS = 4096, 65_536, (0.15, 0.0, -0.1, -0.3, -1.0)


class ImpactIndex:
    """An index over integer vectors. Impacts are whole numbers, in doubles where they are exact and in 64 bits else."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray):
        self.keys, self.vectors = keys, vectors.astype(np.int64)
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.sort(self.vectors, axis=0).T.copy()
        # Of the largest absolute value, as a Python number: the least of 64 bits has no positive twin.
        self.largest = max(abs(int(self.vectors.max(initial=0))), abs(int(self.vectors.min(initial=0))))
        self.doubles = None

    def search(self, query: np.ndarray, own: int | None, k: int, levels: tuple[float, ...] = LEVELS) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best, own key left out; ties go to the smaller key."""
        q = [int(x) for x in query]
        # What any sum of impacts can reach; beyond 2 ** 53 doubles are no longer exact, beyond 2 ** 62 whole numbers are taken one by one.
        reach = self.largest * max(map(abs, q), default=0) * len(q)
        if reach >= 1 << 62:
            return self._one_by_one(q, own, k)
        if reach < 1 << 53 and self.doubles is None:
            self.doubles = self.vectors.astype(np.float64)
        vectors, weights_of = (self.doubles, np.float64) if reach < 1 << 53 else (self.vectors, np.int64)
        n, query = len(self.keys), np.array(q, weights_of)
        whole = np.array(q, np.int64)
        ends = np.stack([whole * self.values[:, 0], whole * self.values[:, -1]])
        best, worst = ends.max(axis=0), int(ends.min(initial=0))
        top = int(best.max(initial=0))
        given = np.zeros(n, weights_of)  # the impacts so far
        counted = np.zeros(n, np.int64)  # and how many they were
        at = [0] * len(q)  # postings processed of each list
        floor, possible = None, np.arange(n)
        for share in levels:
            level = int(top * share) if share >= 0 else min(-1, -int(share * worst) if share > -1 else worst - 1)
            begun = (best > level) & (whole != 0)
            for d in np.flatnonzero(begun).tolist():
                values = self.values[d]
                # Impacts above the level: the largest values for a positive weight, the smallest for a negative one.
                if q[d] > 0:
                    to = n - int(values.searchsorted(level // q[d], side="right"))
                    span = slice(n - to, n - at[d])
                else:
                    to = int(values.searchsorted(-((-level) // q[d]), side="left"))
                    span = slice(at[d], to)
                if to > at[d]:
                    rows = self.order[d, span]  # each row once
                    given[rows] += values[span] * query[d]
                    counted[rows] += 1
                    at[d] = to
            unseen = begun.sum() - counted
            bound = given + unseen * level + best[~begun].sum()
            few = min(n, 8 * k)
            likely = np.argpartition(bound, n - few)[n - few:]
            scores = vectors[likely] @ query
            if own is not None:
                scores = scores[self.keys[likely] != own]
            if len(scores) >= k:
                reached = np.partition(scores, len(scores) - k)[len(scores) - k]
                floor = reached if floor is None else max(floor, reached)
                possible = np.flatnonzero(bound >= floor)
                if len(possible) <= max(32 * k, n // 4):
                    break
        if own is not None:
            possible = possible[self.keys[possible] != own]
        scores = vectors[possible] @ query
        rank = np.lexsort((self.keys[possible], -scores))[:k]
        return possible[rank], scores[rank].astype(np.int64)

    def _one_by_one(self, q: list[int], own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores in whole numbers of any size, for components so large that a sum might leave 64 bits."""
        rows = np.flatnonzero(self.keys != own) if own is not None else np.arange(len(self.keys))
        scores = [sum(x * y for x, y in zip(q, self.vectors[i].tolist())) for i in rows]
        best = heapq.nsmallest(k, zip([-s for s in scores], self.keys[rows].tolist(), rows.tolist()))
        if any(abs(s) >= 1 << 63 for s, _, _ in best):
            raise OverflowError("a score is beyond 64 bits")
        return np.array([i for _, _, i in best], np.int64), np.array([-s for s, _, _ in best], np.int64)


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, ints): each component x as floor(scale * x). Vectors that are null, or hold a null or a
    component that is not finite, are left out. A component that leaves 64 bits by it is an error."""
    x = F.col(quoted(vector)).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    wide = F.exists(x, lambda c: F.abs(c * scale) >= 2.0 ** 63)
    whole = F.when(wide, F.raise_error(F.lit("a component is beyond 64 bits")).cast("array<bigint>")).otherwise(
        F.transform(x, lambda c: F.floor(c * scale)))
    return vectors.where(F.col(quoted(key)).isNotNull() & x.isNotNull() & ~bad).select(F.col(quoted(key)).cast("long").alias("key"), whole.alias("ints"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, key: str = "vec_id",
          vector: str = "embedding", per_pass: int = QUERIES, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, key, score): the k best of ``vectors`` for every row of ``queries`` but the row's own key.

    Scores are integer inner products of the quantised components; ties go to the smaller key. Fewer
    rows come back where there are fewer candidates. Vectors of another length than the query's take no
    part for it, nor do those without a key. Rows that repeat a key are rows of their own, and all rows
    with the query's key are left out. Queries go to the tasks in passes of about ``per_pass``, one pass after
    the other: the driver and every task hold those of one pass, and a pass's results are stored before the next.
    Products and sums are exact whatever the size of the components; a score or a scaled component beyond 64 bits
    is an error. An empty table on either side gives no rows. Columns of other names are not read. A vector of any
    length is taken; very long ones make an index block of as many numbers.
    """
    spark = ensure(vectors.sparkSession)
    rows = quantised(vectors, key, vector, scale)
    asked = stored(quantised(queries, key, vector, scale).distinct(), "top-k-queries")
    passes = max(1, -(-asked.count() // per_pass))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    parts = []

    for number in range(passes):
        # A hash spreads the queries; a pass holds about per_pass of them.
        chosen = asked.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == number).toPandas() if passes > 1 else asked.toPandas()
        shared = spark.sparkContext.broadcast([(int(q), np.asarray(v, np.int64)) for q, v in zip(chosen["key"], chosen["ints"])])

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def answers() -> Iterator[pa.RecordBatch]:
                keys, sizes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                flat = np.concatenate([h[2] for h in held])
                starts = np.cumsum(sizes) - sizes
                for length in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == length)
                    index = ImpactIndex(keys[own], flat[starts[own][:, None] + np.arange(length)])
                    out = []
                    for q, v in shared.value:
                        if len(v) == length:
                            at, scores = index.search(v, q, k)
                            out += zip([q] * len(at), index.keys[at].tolist(), scores.tolist())
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "key", "score"])

            count = 0
            for batch in batches:
                lists = column(batch, "ints")
                sizes = np.diff(lists.offsets.to_numpy())
                held.append((column(batch, "key").to_numpy(), sizes, lists.flatten().to_numpy().astype(np.int64)))
                count += len(batch)
                if count >= block:
                    yield from answers()
                    held, count = [], 0
            if held:
                yield from answers()

        found = rows.mapInArrow(search, "query_id long, key long, score long")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "query_id", "rank", F.col("key").alias(key), "score")
        parts.append(stored(best, "top-k"))
        shared.destroy()
    discard(asked)
    return spark.read.parquet(*(p._stored_at for p in parts))
