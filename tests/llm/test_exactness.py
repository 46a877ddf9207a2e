"""Large numbers, long words, parallel reads and clashing names."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import warc
from ebbtide.llm.encoder import vocabulary_path
from ebbtide.llm.jaccard import jaccard_join, keep_one
from ebbtide.llm.licenses import license_scan
from ebbtide.llm.quality import classify
from ebbtide.llm.substrings import remove_repeats
from ebbtide.llm.token_counts import transducer
from ebbtide.llm.topk import ImpactIndex, top_k
from ebbtide.session import shared_dir
from tests.llm import brute

OWN = ("windows", "row", "row_key", "_words", "_hits", "_judged", "_found", "_base", "_poor", "_toxic", "_host", "_path", "_h", "_p", "rows", "chosen",
       "_id", "_md5", "_text", "user", "n", "c0", "the_id", "a.b")


@pytest.mark.parametrize("size", [1, 1000, 10 ** 6, 10 ** 8, 1 << 40])
def test_scores_are_exact(size):
    draw = random.Random(size)
    vectors = [[draw.randrange(-size, size + 1) for _ in range(64)] for _ in range(120)]
    vectors[7], vectors[9] = [-size] * 64, vectors[8]
    index = ImpactIndex(np.arange(120), np.array(vectors))
    for q in range(0, 120, 8):
        scores = [(sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in enumerate(vectors) if i != q]
        want = sorted(scores, key=lambda s: (-s[0], s[1]))[:5]
        if any(abs(s) >= 1 << 63 for s, _ in want):
            with pytest.raises(OverflowError):
                index.search(np.array(vectors[q]), q, 5)
            continue
        rows, got = index.search(np.array(vectors[q]), q, 5)
        assert list(zip(got.tolist(), rows.tolist())) == want


def test_components_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_k(df, df).collect()
    assert top_k(df.limit(0), df.limit(0)).count() == 0


WORDS = {"random": lambda d, n: "".join(d.choices("abcdefghijklmnopqrstuvwxyz", k=n)), "one letter": lambda d, n: "x" * n,
         "period": lambda d, n: ("abcdefg" * (n // 7 + 1))[:n], "accents": lambda d, n: "".join(d.choices("éüßøa", k=n // 2)),
         "digits": lambda d, n: "".join(d.choices("0123456789", k=n)), "mixed": lambda d, n: " ".join("".join(d.choices("abc", k=d.randrange(1, 4000))) for _ in range(n // 2000))}


@pytest.mark.parametrize("kind", WORDS)
def test_long_words(kind):
    machine = transducer(vocabulary_path())
    texts = [WORDS[kind](random.Random(3), n) for n in (5000, 40_000)] + ["end"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = machine.counts(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert got.tolist() == [len(brute.encoded(t)) for t in texts]


def test_a_megabyte_word():
    machine = transducer(vocabulary_path())
    raw = WORDS["one letter"](None, 1 << 20).encode()
    start = time.perf_counter()
    (n,) = machine.counts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert time.perf_counter() - start < 30 and 0 < n < len(raw)


def test_archives_are_read_by_many_tasks(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<p>"), F.repeat(F.col("id").cast("string"), 50)).alias("html"))
    path = shared_dir(spark, "many").removeprefix("file:")  # without a scheme
    archives = warc.write_archives(pages.repartition(20), path)
    assert archives.count() == 20 and warc.qualified(spark, path).startswith("file:")
    read = warc.read_archives(archives, path)
    assert read.withColumn("task", F.spark_partition_id()).select("task").distinct().count() >= min(spark.sparkContext.defaultParallelism, 20) > 1
    assert read.count() == 400


@pytest.mark.parametrize("name", ["op5", "op6", "op10", "keep_one"])
def test_clashing_names(spark, name):
    rows = [(i, f"The quick brown fox number {i % 4} jumps over a lazy dog under the MIT License " + "again and again " * 8, "en", f"s{i % 2}") for i in range(8)] + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select(
        "*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in OWN])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    out = {"op5": lambda: remove_repeats(docs), "op6": lambda: license_scan(docs), "op10": lambda: classify(docs, labels),
           "keep_one": lambda: keep_one(docs, jaccard_join(docs.select("doc_id", "text")))}[name]()
    assert out.columns[:len(docs.columns)] == docs.columns
    kept = [r.asDict() for r in out.collect()]
    assert len(kept) == (9 if name != "keep_one" else len(kept)) and kept
    for r in kept:
        tail = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert all(r[c] == c + tail for c in OWN)
