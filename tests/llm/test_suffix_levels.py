"""Long repeats against a plain version, and the family of levels."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import suffix_levels
from ebbtide.llm.suffix_levels import SuffixLevels, entries, equal_numbers, ranks, remove_long_repeats, smallest
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "sha")
PASSAGE = "".join(random.Random(1).choices("abcdefgh ", k=400))


def result(df):
    df = df.withColumn("sha", F.sha2("kept", 256))
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


TEXTS = [None, "", "short", PASSAGE, PASSAGE, "before " + PASSAGE + " after", PASSAGE[:150] + "#" + PASSAGE[120:], "x" * 700, "y" + "x" * 99, "x" * 100,
         "ab" * 300, "é" * 160 + PASSAGE[50:260], "中文" * 90, PASSAGE[:99], PASSAGE[300:] + PASSAGE[:100], " ".join([PASSAGE[10:130]] * 4), "é" * 49 + "z" + "é" * 49]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3, t, i) for i, t in enumerate(TEXTS)] + [(9, PASSAGE, None), (None, PASSAGE + PASSAGE, 5), (None, None, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_spans int").selectExpr(
        "*", *(f"concat('{c}', doc_id) as `{c}`" for c in ("row", "spans", "user", "h", "c", "row_key", "n", "c0", "a.b"))).repartition(3)


@pytest.mark.parametrize("batches, crowded", [(1, 1000), (5, 1000), (3, 1)])
def test_odd_rows(odd, batches, crowded, monkeypatch):
    monkeypatch.setattr(suffix_levels, "CROWDED", crowded)
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = remove_long_repeats(odd, batches=batches)
    assert got.columns == [c for c in odd.columns if c != "n_spans"] + ["n_bytes", "n_removed", "n_spans", "kept"]
    assert result(got) == Counter(brute.without_long_repeats(docs))
    assert {r["row"] for r in got.collect()} == {r["row"] for r in odd.collect()}


@pytest.mark.parametrize("size, run", [(100, 32), (40, 20), (7, 7)])
def test_small(spark, size, run):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    if size < 40:
        docs = docs.where("length(text) < 600")
    want = Counter(brute.without_long_repeats([tuple(r) for r in docs.collect()], size))
    assert result(remove_long_repeats(docs, size, run)) == want


def test_empty(spark):
    assert remove_long_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_levels(spark):
    """Equal levels merge, and later batches meet all that stand."""
    index = SuffixLevels(spark, 4)
    rows = spark.createDataFrame([(i, i, PASSAGE if i % 3 == 0 else f"{i:09d}" * 30) for i in range(21)], "doc_id long, row long, text string")
    for k in range(7):
        index.add(rows.where(f"doc_id >= {3 * k} and doc_id < {3 * k + 3}"))
    assert [n for n, _ in index.levels] == [4, 2, 1]
    level = index.levels[0][1]
    assert level.count() == level.distinct().count() and level.columns == ["h"]
    plan = level.join(index.arrays[0].select("h").hint("shuffle_hash"), "h", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    gone = {r["row"] for r in index.spans(rows).collect()}
    assert gone >= {i for i in range(1, 21) if i % 3 == 0} and not index.levels


def test_parts(monkeypatch):
    """A text in parts gives the same windows."""
    data = np.frombuffer((PASSAGE * 20).encode(), np.uint8)
    offsets = np.array([0, 3000, 3000, 3050, len(data)])

    def windows():
        return sorted(w for t, _, _, s, n, _ in entries(data, offsets, 100, 32) for a, b, k in zip(t.tolist(), s.tolist(), n.tolist()) for w in
                      ((a, b + j) for j in range(k)))

    want = windows()
    assert want == [(t, i) for t in range(4) for i in range(int(offsets[t + 1] - offsets[t]) - 99)]
    monkeypatch.setattr(suffix_levels, "PART", 333)
    assert windows() == want


def test_smallest_and_ranks():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 50, 200).astype(np.uint64)
    assert smallest(values, 9).tolist() == [values[i:i + 9].min() for i in range(192)]
    data = draw.integers(97, 99, 300).astype(np.uint8)
    at = np.arange(290)
    strings = [data[i:i + 10].tobytes() for i in at]
    assert ranks(data, at, 10).tolist() == [sorted(set(strings)).index(s) for s in strings]
    numbers = equal_numbers(data, at, 10).tolist()
    assert len(set(zip(numbers, strings))) == len(set(numbers)) == len(set(strings))


def test_a_collision_of_hashes_is_seen(monkeypatch):
    monkeypatch.setattr(suffix_levels, "hashes", lambda data, size: [np.zeros(len(data) - size + 1, np.uint64)])
    data = np.frombuffer(b"abcabdabc", np.uint8)
    numbers = equal_numbers(data, np.array([0, 3, 6]), 3).tolist()
    assert numbers[0] == numbers[2] != numbers[1]
