"""Pruned text search and bucket search against scoring everything."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import retrieve as rt
from ebbtide.operators import search as se


def brute(queries, articles, k):
    split = lambda t: Counter(w for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split())
    docs = {i: split(t) for i, t in articles}
    df = Counter(w for d in docs.values() for w in d)
    idf = {w: math.log((len(articles) + 1) / (n + 1)) + 1 for w, n in df.items()}
    weights = {i: {w: n * idf[w] for w, n in d.items()} for i, d in docs.items()}
    norms = {i: math.sqrt(sum(x * x for x in d.values())) for i, d in weights.items()}
    out = {}
    for q, t in queries:
        asked = {w: n * idf[w] for w, n in split(t).items() if w in idf}
        norm = math.sqrt(sum(x * x for x in asked.values()))
        scores = []
        for i, d in weights.items():
            dot = sum(x * asked[w] for w, x in d.items() if w in asked)
            if any(w in asked for w in d):
                scores.append((-round(dot / (norms[i] * norm), 9), i))
        for rank, (s, i) in enumerate(sorted(scores)[:k], 1):
            out[q, rank] = i, -s
    return out


@pytest.mark.parametrize("block, seeds, k", [(128, 48, 3), (4, 1, 1), (16, 3, 50)])
def test_pruning_loses_nothing(spark, monkeypatch, block, seeds, k):
    monkeypatch.setattr(se, "BLOCK_ARTICLES", block)
    monkeypatch.setattr(se, "SEED_POSTINGS", seeds)
    draw = random.Random(block)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]  # a few words stand everywhere
    articles = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 2, 5, 30, 200])))) for i in range(250)]
    articles += [(300, articles[7][1]), (301, articles[7][1]), (302, ""), (303, None)]  # ties and empty ones
    queries = [(i, " ".join(draw.choices(vocabulary, weights, k=12))) for i in range(12)]
    queries += [(50, articles[7][1]), (51, vocabulary[0]), (52, "absent"), (53, ""), (54, None)]
    got = se.text_search(spark.createDataFrame(queries, "query_id long, text string"),
                         spark.createDataFrame(articles, "article_id long, text string").repartition(3), k)
    got = {(r.query_id, r["rank"]): (r.article_id, r.score) for r in got.collect()}
    want = brute(queries, articles, k)
    assert {key: v[0] for key, v in got.items()} == {key: v[0] for key, v in want.items()}
    assert all(abs(got[key][1] - want[key][1]) < 1e-8 for key in want)


def test_common_words_make_no_candidates(spark):
    """Every article holds the common word, few hold the rare one: only these are scored."""
    articles = spark.range(3000).select(F.col("id").alias("article_id"), F.concat(
        F.lit("common word here "), F.when(F.col("id") % 1000 == 0, "rarest").otherwise(F.concat(F.lit("x"), F.translate(
            F.col("id").cast("string"), "0123456789", "abcdefghij")))).alias("text"))
    index = se.build_index(articles, "article_id", "text")
    counts = se.term_counts(spark.createDataFrame([(1, "common rarest")], "query long, text string"), "query", "text")
    asked = counts.join(index.rarity, "term").select("query", "term", "idf", (F.col("tf") * F.col("idf")).alias("qw")).cache()
    asked = asked.withColumn("qnorm", F.lit(asked.agg(F.sqrt(F.sum(F.col("qw") * F.col("qw")))).first()[0]))
    least, _ = se.thresholds(asked, index, 3)
    assert se.candidates(asked, index, least).count() <= 10


def test_empty_sides(spark):
    none = spark.createDataFrame([], "query_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    assert se.text_search(none, some.withColumnRenamed("query_id", "article_id")).count() == 0
    assert se.text_search(some, none.withColumnRenamed("query_id", "article_id")).count() == 0


def test_buckets_find_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    items = np.vstack([c + 0.4 * rng.normal(size=(25, 16)) for c in centres])
    i = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(items)] + [(5000, [0.0] * 16), (5001, None)], "item_id long, vector array<double>")
    q = spark.createDataFrame([(k, (c + 0.2 * rng.normal(size=16)).tolist()) for k, c in enumerate(centres)], "query_id long, vector array<double>")
    exact = {(r.query_id, r.item_id) for r in rt.vector_topk(q, i, 10).collect()}
    near = [(r.query_id, r.item_id, r.score) for r in rt.approximate_topk(q, i, 10, recall=0.95).collect()]
    assert len(exact & {(a, b) for a, b, _ in near}) >= 0.9 * len(exact)
    unit = lambda v: v / np.linalg.norm(v)
    asked = {r.query_id: np.array(r.vector) for r in q.collect()}
    assert all(abs(unit(items[b]) @ unit(asked[a]) - s) < 1e-8 for a, b, s in near)


def test_plan_of_buckets():
    cosines = np.full(50, 0.8)
    tables, bits = rt.plan_buckets(cosines, 1_000_000, 0.95)
    assert 1 - (1 - rt.collision(0.8, bits)) ** tables >= 0.95 and bits > 5
    assert rt.plan_buckets(np.full(5, -0.999), 1000, 0.99) == (1, 0) or rt.plan_buckets(np.full(5, -0.999), 1000, 0.99)[1] <= 1


def test_blocks_find_the_same(spark, monkeypatch):
    """Null, equal and zero vectors, ids that repeat; several blocks of queries and pieces of items."""
    rng = np.random.default_rng(6)
    items = np.vstack([rng.normal(size=(300, 8)), np.zeros((2, 8))])
    items[200:240] = items[7]
    rows = [(k, v.tolist()) for k, v in enumerate(items)] + [(5, items[9].tolist()), (999, None)]
    i = spark.createDataFrame(rows, "item_id long, vector array<double>").repartition(3)
    q = i.filter("item_id % 9 = 0").withColumnRenamed("item_id", "query_id")
    monkeypatch.setattr(rt, "FIRST_ITEMS", 3)
    want = []
    for a, v in rows:
        if a % 9 == 0 and v is not None:
            norm = max(np.linalg.norm(v), 1e-300)
            scores = [(-round(float(np.dot(v, w) / norm / max(np.linalg.norm(w), 1e-300)), 9) + 0.0, b) for b, w in rows if w is not None]
            want += [(a, b) for _, b in sorted(scores)[:6]]
    for block in (4096, 7):
        got = [(r.query_id, r.item_id) for r in rt.vector_topk(q, i, 6, block=block).collect()]
        assert sorted(got) == sorted(want)


def test_approximate_search_makes_no_pairs(spark):
    """Pairs that share a bucket stay in the task that finds them: rows grow with queries, not with pairs."""
    rng = np.random.default_rng(8)
    close = rng.normal(size=16) + 0.05 * rng.normal(size=(600, 16))  # all in the same buckets
    i = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(close)], "item_id long, vector array<double>").repartition(2)
    buckets = rt.Buckets.draw(4, 2, 16)
    rows = [(r.query_id, r.item_id) for r in rt._scan([(k, v) for k, v in enumerate(close[:200].tolist())], i, 3, True, buckets).collect()]
    assert len(rows) <= 2 * 200 * 3
    same = {(a, b) for a in range(200) for b in range(600) if (buckets.of(close[[a]]) == buckets.of(close[[b]])).any()}
    assert same.issuperset(rows)
    q = i.filter("item_id < 200").withColumnRenamed("item_id", "query_id")
    exact, near = ({(r.query_id, r.item_id) for r in f(q, i, 3).collect()} for f in (rt.vector_topk, rt.approximate_topk))
    assert len(exact & near) >= 0.9 * len(exact)


def test_few_pairs_are_scored_exactly(monkeypatch):
    """Once there is a score to beat, a task scores and sorts only what may beat it."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(20_000, 16))
    asked = [(k, v) for k, v in enumerate(vectors[:50].tolist())]
    seen, dots = [], rt._dots
    monkeypatch.setattr(rt, "_dots", lambda q, i, rows, columns: (seen.append(len(rows)), dots(q, i, rows, columns))[1])

    class Items:
        def mapInArrow(self, work, schema):
            flat = pa.array(vectors.ravel())
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 16), pa.int32()), flat)
            return [*work([pa.RecordBatch.from_arrays([pa.array(np.arange(len(vectors))), column], ["item_id", "vector"])])]

    (found,) = rt._scan(asked, Items(), 3, True)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = [j for q in unit[:50] for j in np.lexsort((np.arange(len(unit)), -(unit @ q).round(9)))[:3]]
    assert found.column(1).to_pylist() == want
    assert sum(seen) < 0.02 * 50 * len(vectors)


def test_index_holds_what_is_asked(spark):
    """Postings of the wanted terms only, lengths of all words; the counts behind them are not left over."""
    import os

    articles = spark.createDataFrame([(1, "a b b c"), (2, "b d e"), (None, "a e"), (2, "b")], "article_id long, text string")
    whole = se.build_index(articles, "article_id", "text")
    folder = os.path.dirname(whole.postings.inputFiles()[0].removeprefix("file:"))
    left = lambda: {f for f in os.listdir(os.path.dirname(folder)) if f.startswith("search-terms")}
    before = left()
    some = se.build_index(articles, "article_id", "text", spark.createDataFrame([("b",), ("e",), ("x",), ("b",)], "term string"))
    rows = lambda d: sorted(((r.article or 0, r.term, tuple(r.block), round(r.w, 9), round(r.norm, 9)) for r in d.collect()))
    assert rows(some.postings) == [r for r in rows(whole.postings) if r[1] in ("b", "e")] and len(rows(some.postings)) == 4
    assert some.rarity.count() == whole.rarity.count() == 5
    assert left() == before
