"""Benchmark decontamination by multi-pattern search after Wu and Manber.

The symbols are words. All windows of the same number of words form one search: a table by blocks of
two words tells how far the search may move on, blocks that end a window lead to a bucket by the hash
of the suffix, and only the members of the bucket are compared with the text. Words that no window
holds move the search by a whole window.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import column, ensure, slices, stored

#: A word, and the letters that are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}
WINDOW = 13
#: Words of benchmark items that one pass holds in memory.
PASS_WORDS = 2_000_000

find_words = re.compile(WORD).findall


def words_of(text: str | None) -> list[str]:
    return find_words(text.translate(LOWER)) if text else []


class Search:
    """Occurrences of equally long word windows."""

    def __init__(self, length: int):
        self.length = length
        self.windows: dict[tuple[str, ...], set] = defaultdict(set)

    def add(self, window: tuple[str, ...], item) -> None:
        self.windows[window].add(item)

    def compile(self) -> "Search":
        self.block = min(2, self.length)
        self.far = self.length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for window in self.windows:
            for end in range(self.block, self.length + 1):
                key = window[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.far), self.length - end)
            self.buckets[hash(window[-self.block:]), window[0]].append(window)
        self.buckets = dict(self.buckets)
        return self

    def occurrences(self, words: list[str]) -> Iterator[tuple[int, set]]:
        """(start, items) of every place where a window stands."""
        length, block, far = self.length, self.block, self.far
        shift, buckets, n = self.shift.get, self.buckets.get, len(words)
        end = length
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            move = shift(key, far)
            if move:
                end += move
                continue
            start = end - length
            for window in buckets((hash(key), words[start]), ()):
                if tuple(words[start:end]) == window:
                    yield start, self.windows[window]
            end += 1


class Patterns:
    """All windows of a set of items; items of fewer words than a window are one window."""

    def __init__(self, items: list[tuple[object, str | None]], size: int = WINDOW):
        searches: dict[int, Search] = {}
        for item, text in items:
            words = words_of(text)
            n = min(size, len(words))
            for start in range(len(words) - n + 1 if n else 0):
                searches.setdefault(n, Search(n)).add(tuple(words[start:start + n]), item)
        self.searches = [searches[n].compile() for n in sorted(searches)]

    def hits(self, words: list[str]) -> tuple[list[list[int]], set]:
        """(disjoint spans of hit words, items with a window in the text)."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        for search in self.searches:
            for start, found in search.occurrences(words):
                spans.append((start, start + search.length))
                items |= found
        return merge(spans), items


def merge(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, one_in: int = 20, size: int = WINDOW,
                  text: str = "text", pass_words: int = PASS_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans, hit_items and contaminated.

    ``hit_spans`` are disjoint [start, end) word spans, ``hit_items`` the sorted ids, as strings, of the
    items with an occurring window. A document is contaminated if it has hit words and at least
    one in ``one_in`` of its words is hit. Null texts have no words; items of null id, null text or no word take
    no part; repeated items and rows count as they are. Columns of ``docs`` with the names of the new
    ones are replaced. The patterns are held in passes of at most ``pass_words`` words each (an item is
    never split), so the broadcast is bounded however large the benchmark is; passes follow each other,
    with the spans found so far carried along.
    """
    spark = ensure(docs.sparkSession)
    new = ("n_words", "n_hit", "hit_spans", "hit_items", "contaminated")
    kept = [f for f in docs.schema if f.name not in new]
    rows = docs.select(*(F.col(f"`{f.name}`") for f in kept), F.lit(None).cast("array<array<int>>").alias("hit_spans"),
                       F.lit(None).cast("array<string>").alias("hit_items"), F.lit(0).cast("long").alias("n_words"))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text")
    # A word and its gap are two bytes at least, so the number of passes keeps each within its bound on average.
    most = items.agg(F.sum(F.length("text") / 2).alias("n")).first()["n"] or 0
    passes = max(1, int(-(-most // pass_words)))
    schema = rows.schema

    for number in range(passes):
        chosen = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).toLocalIterator()]
        shared = spark.sparkContext.broadcast(chosen)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = Patterns(shared.value, size)
            for piece in slices(batches, text):
                spans, found, count = [], [], []
                for value, s, i in zip(*(column(piece, c).to_pylist() for c in (text, "hit_spans", "hit_items"))):
                    words = words_of(value)
                    own, names = patterns.hits(words)
                    spans.append(merge([tuple(x) for x in (s or [])] + [tuple(x) for x in own]))
                    found.append(sorted(names | set(i or [])))
                    count.append(len(words))
                columns = [column(piece, f.name) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(found, pa.list_(pa.string())),
                     pa.array(count, pa.int64())], [*(f.name for f in kept), "hit_spans", "hit_items", "n_words"])

        rows = rows.mapInArrow(search, schema)
        if number + 1 < passes:
            rows = stored(rows, "decontaminate")
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))
    return rows.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).select(
        *(f"`{f.name}`" for f in kept), *new)
