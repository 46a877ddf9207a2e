"""What operators shuffle, write and hold must grow with what they decide on, not with all texts."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from ebbtide.llm import alignment, substrings
from ebbtide.llm.encoder import BPE_50K
from ebbtide.llm.jaccard import jaccard_join, keep_one
from ebbtide.llm.runtime import marked
from ebbtide.llm.substrings import remove_repeats
from tests.llm import brute


def prose(rnd, n):
    return " ".join(f"w{rnd.randrange(10**9)}" for _ in range(n))


def shuffled(plan):
    """Bytes that the shuffles of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(shuffled(children.apply(i)) for i in range(children.size()))


def test_marked(spark):
    keys = spark.range(-50, 50).select(F.xxhash64("id").alias("key"))
    rows = marked(spark.range(-2000, 2000), F.xxhash64("id"), keys).collect()
    may = {r["id"] for r in rows if r["may"]}
    assert len(rows) == 4000 and set(range(-50, 50)) <= may and len(may) < 110
    few = marked(spark.range(1000), F.xxhash64("id"), keys, bits=64).where("may").count()  # a full table holds nothing back
    assert few >= 50
    assert marked(spark.range(5), F.xxhash64("id"), keys.limit(0)).where("may").count() == 0


def test_keep_one_shuffles_no_text_that_stays(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, 300)) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(5)] + [(7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_one(docs, jaccard_join(docs).localCheckpoint())
        got = kept.collect()
        assert shuffled(kept._jdf.queryExecution().executedPlan()) < sum(len(t) for _, t in rows) / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert Counter(map(tuple, got)) == Counter(rows[:200])


def test_a_common_passage_has_one_row_for_each_anchor(spark, monkeypatch):
    """However crowded its anchors are, a place is not taken apart into windows."""
    rnd = random.Random(2)
    passage, line = prose(rnd, 60), prose(rnd, 14)
    rows = [(i, f"{prose(rnd, 20)} {passage} {prose(rnd, 20)} {line} {prose(rnd, 3)}") for i in range(40)] + [(100, None), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept, counts = substrings.stored, {}

    def counted(df, label):
        out = kept(df, label)
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(substrings, "stored", counted)
    want = Counter(brute.without_repeats(rows[:-1]))
    for crowded in (10, 1000):
        out = remove_repeats(docs.where("doc_id is not null"), crowded=crowded)
        got = [(r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in out.collect()]
        assert Counter(got) == want
    few, plain = counts["places"]
    assert few == plain < 40 * 48 / 2


class Rows:
    """Stands for a frame and gives the function that its tasks run."""

    def mapInArrow(self, work, schema):
        return work


def test_alignment_holds_little_of_a_batch():
    """Executors ran out of memory where two workers each held hundreds of bytes for every byte of 2 MB."""
    rnd = random.Random(3)
    words = [prose(rnd, 1) for _ in range(500)] + ["the", "of", "and"] * 200
    texts = [" ".join(rnd.choices(words, k=300)) for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    work = alignment._blocks(Rows(), BPE_50K, alignment.PIECES_32K, alignment.BLOCK_BYTES)
    alignment.aligner(BPE_50K, alignment.PIECES_32K)
    assert batch.nbytes > 2 << 20
    tracemalloc.start()
    try:
        blocks = list(work(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(b["doc_id"][0]) for b in blocks) == len(texts)
    assert peak < 100 << 20, peak
