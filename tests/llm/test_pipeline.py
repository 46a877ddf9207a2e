"""The pipeline, stage by stage, against plain versions on the stage's own input."""

from __future__ import annotations

import corpus_pipeline
from ebbtide.llm.quality import classify
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = texts(docs)
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns
        after = texts(docs)
        if n == 0:
            source = spark.read.parquet(f"{SMALL}/documents.parquet")
            keep = {r["doc_id"] for r in classify(source, spark.read.parquet(f"{SMALL}/labels.parquet")).where("keep").collect()}
            assert after == {d: t for d, t in before.items() if d in keep} and len(after) < len(before)
        elif n == 1:
            assert sorted(after) == sorted({c for _, c, _ in brute.similar_documents(list(before.items()))})
        elif n == 2:
            want = {d: (r, s) for d, _, r, s in brute.without_repeats(list(before.items()))}
            for d, t in after.items():
                removed, digest = want[d]
                assert brute.sha(t) == digest if removed else t == before[d]
            assert set(after) == set(before)
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            dirty = {r[0] for r in brute.decontaminated(list(before.items()), items) if r[5]}
            assert after == {d: t for d, t in before.items() if d not in dirty}
        kept.append(len(after))
    pieces = corpus_pipeline.packing(spark, docs, SMALL)
    total = {d: 0 for d in after}
    for r in pieces.collect():
        total[r["doc_id"]] += r["length"]
    assert total == {d: len(brute.encoded(t)) + 1 for d, t in after.items()}


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    assert out.count() > 0
