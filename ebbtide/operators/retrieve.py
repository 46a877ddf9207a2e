"""Nearest-neighbour search of vectors, exact and through locality-sensitive buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import shared_dir, without_shuffle_files
from ebbtide.sources.sinks import materialize_once, write_overwrite

QUERY_BLOCK = 4096  # query vectors that travel to every task at once
#: Scores that a task holds at once; its first items come in smaller numbers, until there is a score to beat.
SCORES_AT_ONCE, FIRST_ITEMS = 1 << 22, 64
FOUND = "query_id bigint, item_id bigint, score double"
#: In the place of an item: none yet, and one whose id is null.
_FREE, _NULL = np.iinfo(np.int64).max, np.iinfo(np.int64).max - 1

#: (row of the queries, column of the items) of the pairs that may count, in order of rows.
Pairs = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _dots(queries: np.ndarray, items: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The product of each pair, rounded to nine digits."""
    if len(rows) * 16 > len(queries) * len(items):
        return (queries @ items.T)[rows, columns].round(9)
    step = max(1, (1 << 20) // max(1, queries.shape[1]))
    parts = [np.einsum("ij,ij->i", queries[rows[a:a + step]], items[columns[a:a + step]]) for a in range(0, len(rows), step)]
    return np.concatenate([np.zeros(0), *parts]).round(9)


class _Best:
    """The k highest scores of each query with their item ids; ties go to the smaller id, what is no number comes last."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), _FREE)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.where(np.isnan(scores), -np.inf, scores)
        wanted = scores >= self.scores[rows, -1]
        rows, scores, ids = rows[wanted], scores[wanted], ids[wanted]
        k, (met, at) = self.ids.shape[1], np.unique(rows, return_inverse=True)
        if not len(met):
            return
        group = np.concatenate([np.repeat(np.arange(len(met)), k), at])
        scores, ids = np.concatenate([self.scores[met].ravel(), scores]), np.concatenate([self.ids[met].ravel(), ids])
        order = np.lexsort((ids, -scores, group))
        count = np.bincount(group)
        order = order[np.arange(len(order)) - np.repeat(np.cumsum(count) - count, count) < k]
        self.scores[met], self.ids[met] = scores[order].reshape(-1, k), ids[order].reshape(-1, k)

    def found(self, query_ids: np.ndarray) -> pa.RecordBatch:
        taken = self.ids != _FREE
        ids, scores = self.ids[taken], self.scores[taken]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(query_ids, taken.sum(axis=1))), pa.array(ids, mask=ids == _NULL),
             pa.array(np.where(np.isneginf(scores), np.nan, scores))], ["query_id", "item_id", "score"])


def _items(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors as rows) of a batch; all vectors are of one length."""
    ids, column = batch.column(0), batch.column(1)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    if len(column) and (np.diff(column.offsets.to_numpy()) != len(flat) // len(column)).any():
        raise ValueError("vectors differ in length")
    return ids.fill_null(_NULL).to_numpy(), flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _rank(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _vectors(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias(name), F.col(vector).cast("array<double>").alias("vector")).filter(
        F.col("vector").isNotNull())


def vector_topk(
    queries: DataFrame, items: DataFrame, k: int = 3, metric: str = "cosine",
    query_id: str = "query_id", item_id: str = "item_id", vector: str = "vector", block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, score, item_id: the k items with the highest cosine or dot product.

    Queries go out in blocks of a bounded size. For each block the items are scanned once: every task scores its own
    items by matrix product and returns k rows per query, so items are never shuffled and no pair table exists. The
    blocks' results are stored one by one.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unknown metric {metric}")
    q, i = _vectors(queries, query_id, vector, "query_id"), _vectors(items, item_id, vector, "item_id")
    return _in_blocks(materialize_once(q, "vector-queries"), i, k, metric == "cosine", block)


def _in_blocks(asked: DataFrame, items: DataFrame, k: int, cosine: bool, block: int = QUERY_BLOCK, buckets: Buckets | None = None) -> DataFrame:
    """The ranked hits of all stored queries, one block after the other; with buckets, hits share one with their query.

    Items that several blocks scan are stored first, dealt out evenly to as many files as tasks run at a time: a task
    returns k rows per query, so more tasks than that only make more rows. What a block has shuffled goes with it.
    """
    spark = asked.sparkSession
    n_blocks = max(1, -(-asked.count() // block))
    path = shared_dir(spark, "vector-found")
    with without_shuffle_files(spark):
        blocks = [asked]
        if n_blocks > 1:
            items = materialize_once(items.repartition(spark.sparkContext.defaultParallelism), "vector-items")
            # Blocks are cut at ids, so rows of one id stay together; a block is as large as the ids allow.
            edges = sorted(set(asked.agg(
                F.percentile_approx("query_id", [j / n_blocks for j in range(1, n_blocks)], 10 * n_blocks)).first()[0]))
            number = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col("query_id")))
            asked = write_overwrite(asked.withColumn("block", number).repartition("block"), shared_dir(spark, "vector-blocks"), ("block",))
            blocks = [asked.filter(F.col("block") == j).drop("block") for j in range(len(edges) + 1)]
        for part in blocks:
            _rank(_scan(part.collect(), items, k, cosine, buckets), k).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _scan(asked: list, items: DataFrame, k: int, cosine: bool, buckets: Buckets | None = None) -> DataFrame:
    """The k best hits of each query among the items of each task.

    A task keeps the scores to beat. Pairs that may beat one are found from products of half the digits, with room for
    what these lack, or are those that share a bucket; only they are scored exactly.
    """
    ids = np.array([r[0] for r in asked], dtype="int64")
    matrix = np.array([r[1] for r in asked], dtype="float64") if asked else np.zeros((0, 0))
    matrix = _unit(matrix) if cosine and len(asked) else matrix

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, size = _Best(len(ids), k), FIRST_ITEMS
        most = max(FIRST_ITEMS, SCORES_AT_ONCE // max(1, len(ids)))
        coarse = matrix.astype("float32") if cosine else matrix
        # Products of unit vectors are wrong by this at most; rounding to nine digits takes the rest.
        room = (matrix.shape[1] + 8) * 2.0 ** -23 + 1e-9 if cosine else 1e-9
        shared = buckets.shared(matrix) if buckets and len(ids) else None
        for batch in batches if len(ids) else ():
            found, vectors = _items(batch)
            vectors = _unit(vectors) if cosine else vectors
            at = 0
            while at < len(found):
                part, part_ids = vectors[at:at + size], found[at:at + size]
                if shared:
                    rows, columns = shared(part)
                else:
                    below = coarse @ part.T.astype(coarse.dtype) < (best.scores[:, -1:] - room).astype(coarse.dtype)
                    rows, columns = np.nonzero(np.logical_not(below, out=below))
                best.add(rows, _dots(matrix, part, rows, columns), part_ids[columns])
                at, size = at + size, min(2 * size, most)
        if len(ids):
            yield best.found(ids)

    return items.mapInArrow(scan, FOUND)


#: Largest number of planes of one table, and of tables.
MOST_BITS, MOST_TABLES = 24, 256


@dataclass
class Buckets:
    """Random planes by table: vectors on the same side of all planes of a table share its bucket."""

    planes: np.ndarray  # table, plane, entry

    @classmethod
    def draw(cls, tables: int, bits: int, size: int, seed: int = 0) -> Buckets:
        return cls(np.random.default_rng(seed).standard_normal((tables, bits, size)))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector (row) in each table (column)."""
        tables, bits, size = self.planes.shape
        flat, out, step = self.planes.reshape(-1, size).T, np.zeros((len(vectors), tables), np.int64), max(1, (1 << 20) // max(1, tables * bits))
        for at in range(0, len(vectors), step):
            sides = (vectors[at:at + step] @ flat > 0).reshape(-1, tables, bits) if bits else np.zeros((1, tables, 0), bool)
            out[at:at + step] = sides @ (np.int64(1) << np.arange(bits, dtype=np.int64))
        return out

    def shared(self, queries: np.ndarray) -> Pairs:
        """Which of some items share a bucket with which query: a function of the items' vectors."""
        tables, bits = self.planes.shape[:2]
        first = np.arange(tables, dtype=np.int64) << np.int64(bits)  # the bucket's number begins with its table
        keys = (self.of(queries) + first).ravel()
        order = np.argsort(keys)
        keys, query = keys[order], order // tables

        def pairs(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            mine = (self.of(vectors) + first).ravel()
            low = np.searchsorted(keys, mine)
            count = np.searchsorted(keys, mine, side="right") - low
            upto = np.cumsum(count)
            may, at = np.zeros((len(queries), len(vectors)), bool), 0
            while at < len(mine):  # some million places at once
                to = max(at + 1, int(np.searchsorted(upto, upto[at] - count[at] + SCORES_AT_ONCE, side="right")))
                n = count[at:to]
                place = np.arange(n.sum()) + np.repeat(low[at:to] - np.cumsum(n) + n, n)
                may[query[place], np.repeat(np.arange(at, to) // tables, n)] = True
                at = to
            return np.nonzero(may)

        return pairs


def collision(cosine: np.ndarray, bits: int) -> np.ndarray:
    """The chance that two vectors of a given cosine share a bucket of so many planes."""
    return (1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi) ** bits


def plan_buckets(cosines: np.ndarray, n_items: int, recall: float) -> tuple[int, int]:
    """(tables, bits) that find neighbours of the given cosines with the wanted recall at the least expected work.

    More planes make buckets smaller and need more tables. Work is the rows placed and the candidates met: unrelated
    vectors share a bucket with the chance of cosine 0.
    """
    best = None
    for bits in range(1, MOST_BITS + 1):
        chance = collision(cosines, bits)
        tables = 1
        while tables < MOST_TABLES and np.mean(1 - (1 - chance) ** tables) < recall:
            tables += 1
        if np.mean(1 - (1 - chance) ** tables) >= recall:
            work = tables * (1 + 0.5 ** bits * n_items)
            if best is None or work < best[0]:
                best = work, tables, bits
    return best[1:] if best else (1, 0)


def approximate_topk(
    queries: DataFrame, items: DataFrame, k: int = 3, recall: float = 0.95, sample: int = 200, seed: int = 0,
    query_id: str = "query_id", item_id: str = "item_id", vector: str = "vector",
) -> DataFrame:
    """query_id, rank, score, item_id by cosine: most of the k best, found through shared buckets and scored exactly.

    The number of tables and planes follows from the cosines of the true neighbours of a bounded ``sample`` of the
    queries, which the exact search finds, so that ``recall`` is what to expect of all; where no number of tables within
    the bound can give it, there is one bucket, which is the exact search. Queries go out in blocks with their buckets;
    a task finds those that its items share, scores each such pair once and returns k rows per query, so pairs are in no
    table. Vectors without a direction are in no bucket.
    """
    q, i = _vectors(queries, query_id, vector, "query_id"), _vectors(items, item_id, vector, "item_id")
    asked = materialize_once(q.filter(F.exists("vector", lambda x: x != 0)), "vector-queries")
    known = i.filter(F.exists("vector", lambda x: x != 0))
    some = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    near = np.array([r["score"] for r in vector_topk(some, known, k).select("score").collect()])
    first = known.first()
    if not len(near) or first is None:
        return vector_topk(asked, known, k)
    tables, bits = plan_buckets(near, known.count(), recall)
    return _in_blocks(asked, known, k, True, buckets=Buckets.draw(tables, bits, len(first["vector"]), seed))
