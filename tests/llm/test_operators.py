"""Every operator against a plain version, over a small table and over rows of odd shapes."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import queries
from ebbtide.llm.bitpack import Block, pack, read_ids, unpack, write_block, write_ids
from ebbtide.llm.decontaminate import decontaminate
from ebbtide.llm.jaccard import jaccard_join, keep_one
from ebbtide.llm.licenses import license_scan
from ebbtide.llm.packing import pack_documents
from ebbtide.llm.quality import classify
from ebbtide.llm.substrings import Automaton, remove_repeats
from ebbtide.llm.token_counts import token_counts
from ebbtide.llm.topk import top_k
from ebbtide.llm.warc import read_archives, write_archives
from ebbtide.session import shared_dir
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{i}x" for i in range(60))
TEXTS = [None, "", " \n\t", "one", "One two three", PASSAGE, PASSAGE, "before it " + PASSAGE + " after it", PASSAGE + " more\n" * 3,
         "x" * 5000, "a b " * 3000, "Released under the MIT License. CC BY-NC 4.0; GNU General Public\nLicense", "it's <|endoftext|>we'll  go\n\n",
         "é" * 40 + " 中文 字 ½ ٣   \x1c \x85 end", "mit license mit license apache license", "cc by", PASSAGE.upper(), "tail " * 20 + PASSAGE[:200]]


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]


def same(got, want):
    assert Counter(got) == Counter(want)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", "y", i) for i, t in enumerate(TEXTS)] + [(3, "one", "x", None, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long").repartition(3)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "small"])
def test_token_counts(which, request):
    docs = request.getfixturevalue(which)
    got = rows_of(token_counts(docs.select("doc_id", "text")), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(d, len((t or "").encode()), n := len(brute.encoded(t)), n > 1024) for d, t in texts(docs)]
    same(got, want)


def test_token_counts_keeps_other_columns(odd):
    out = token_counts(odd.withColumn("n_tokens", F.lit("old")))
    assert out.columns == ["doc_id", "lang", "source", "n_words", "n_bytes", "n_tokens", "over_limit"]
    assert out.count() == len(TEXTS) + 1


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 31, 32])
def test_packed_bits(bits):
    import numpy as np
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype("<u4")
    assert (unpack(pack(ids, bits), bits, 1001) == ids).all()
    assert (unpack(pack(ids, bits), bits, 90, 333) == ids[333:423]).all()
    block = Block(write_block(ids, np.array([1, 0, 1000]), [5, None, -2], bits))
    assert block.docs == [5, None, -2] and (block.ids(2) == ids[1:]).all()


@pytest.mark.parametrize("which", ["odd", "small"])
def test_token_files(which, request, spark):
    docs, path = request.getfixturevalue(which), shared_dir(spark, "test-ids")
    write_ids(docs, path, block_ids=500)
    got = rows_of(read_ids(spark, path).withColumn("c", F.crc32("ids")).orderBy("start"), "doc_id", "start", "n_tokens", "c")
    assert [r[0] for r in got] == sorted(d for d, _ in texts(docs))
    at, crcs = 0, Counter((d, brute.crc([*brute.encoded(t), 2])) for d, t in texts(docs))
    for doc, start, n, _ in got:
        assert start == at
        at += n
    assert Counter((r[0], r[3]) for r in got) == crcs


@pytest.mark.parametrize("which", ["odd", "small"])
def test_packing(which, request):
    docs = request.getfixturevalue(which)
    got = rows_of(pack_documents(docs), "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
    sequences, pieces = {}, {}
    for doc, start, n, total, seq, offset, ids in got:
        assert len(ids) == 4 * n and n > 0
        sequences.setdefault(seq, []).append((offset, n))
        pieces.setdefault((doc, total), []).append((start, bytes(ids)))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    want = {}
    for d, t in texts(docs):
        ids = [*brute.encoded(t), 1]
        want.setdefault((d, len(ids)), []).append(brute.np.array(ids, "<u4").tobytes())
    for key, whole in want.items():
        assert b"".join(x for _, x in sorted(pieces[key]))[:len(whole[0])] == whole[0] or len(whole) > 1
        assert sum(len(x) for _, x in pieces[key]) == sum(map(len, whole))
    total = sum(n for own in sequences.values() for _, n in own)
    assert len(sequences) * 2048 - total < 2048 * (docs.rdd.getNumPartitions() + 1) + 0.01 * total


@pytest.mark.parametrize("which", ["odd", "small"])
@pytest.mark.parametrize("pass_words", [2_000_000, 300])
def test_decontamination(which, pass_words, request, spark):
    docs = request.getfixturevalue(which)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text") if which == "small" else spark.createDataFrame(
        [(1, PASSAGE[20:150]), (2, "one"), (3, None), (4, ""), (5, "w3x w4x w5x"), (None, PASSAGE), (2, "one"), (11, "B A")], "item_id long, text string")
    out = decontaminate(docs.select("doc_id", "text"), items, pass_words=pass_words)
    got = [(d, n, h, len(i), brute.sha(",".join(i)), c) for d, n, h, i, c in rows_of(out, "doc_id", "n_words", "n_hit", "hit_items", "contaminated")]
    same(got, brute.decontaminated(texts(docs), [tuple(r) for r in items.collect()]))


@pytest.mark.parametrize("which", ["odd", "small"])
def test_license_base(which, request):
    docs = request.getfixturevalue(which)
    got = rows_of(license_scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same(got, [(d, *brute.base_phrases(t)) for d, t in texts(docs)])
    for score, base, labels in rows_of(license_scan(docs), "score", "base_labels", "labels"):
        assert 0 <= score <= 1 and (not base or score == 1.0) and set(base.split(",")) - {""} <= set(labels.split(","))


def test_license_wordings(spark):
    grant = "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files"
    docs = spark.createDataFrame([(1, "So: " + grant), (2, grant.replace("granted", "denied")), (3, "BSD: Redistribution and use only")], "doc_id long, text string")
    assert sorted(rows_of(license_scan(docs), "doc_id", "labels")) == [(1, "mit"), (2, ""), (3, "")]


@pytest.mark.parametrize("which", ["odd", "small"])
def test_jaccard_join(which, request):
    docs = request.getfixturevalue(which)
    joined = jaccard_join(docs)
    same(rows_of(joined, "doc_id", "class_id", "n_links"), brute.similar_documents(texts(docs)))
    kept = keep_one(docs, joined)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({c for _, c, _ in brute.similar_documents(texts(docs))})


@pytest.mark.parametrize("bucket,block", [(2, 3), (8, 4), (2048, 512)])
def test_jaccard_splits(bucket, block, spark):
    """Near copies in numbers beyond what a bucket or a block holds."""
    base = [f"t{i}" for i in range(120)]
    rows = [(n, " ".join(w if (i * 7 + n * 13) % 97 else f"n{n}" for i, w in enumerate(base))) for n in range(40)]
    rows += [(100 + n, f"other text number {n} with words of its own {n * n} {n + 1} {n + 2}") for n in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(rows_of(jaccard_join(docs, bucket=bucket, block=block), "doc_id", "class_id", "n_links"), brute.similar_documents(rows))


def test_top_k(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    odd = [(1000, None), (1050, [None, 1.0]), (1100, [1.0, 2.0]), (1101, [1.0, 2.0]), (1102, [1.0, -2.0]), (1103, [1.0, 2.0]),
           (1104, [float("nan"), 1.0]), (1150, [0.0, 0.0]), (None, [1.0, 1.0]), (1200, [-1.0, -0.5])]
    vectors = vectors.union(spark.createDataFrame(odd, vectors.schema)).repartition(3)
    want = brute.best([tuple(r) for r in vectors.collect()])
    queries_ = vectors.where("vec_id % 50 = 0")
    for passes in ({}, {"per_pass": 2, "block": 40}):
        same(rows_of(top_k(vectors, queries_, **passes), "query_id", "rank", "vec_id", "score"), want)


@pytest.mark.parametrize("size", [300, 8 << 20])
def test_warc(size, spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "http://a/b c\n", "<p>é</p>"), (2, None, fake), (3, "u", fake), (4, "u", None), (5, "u", ""), (6, "u", fake * 3), (7, "u", "x" * 2000), (8, "u", fake + "y")]
    rows += [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").limit(12).select(F.col("page_id") + 100, "url", "html").collect()]
    pages, path = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), shared_dir(spark, "test-warc")
    read = read_archives(write_archives(pages, path, archive_bytes=3 * size), path, range_bytes=size)
    same(rows_of(read, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), brute.archived(rows))


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fit, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    out = classify(docs, fit).select("doc_id", "keep").join(held, "doc_id")
    right = out.agg(F.avg((F.col("keep") == ((F.col("quality") == 1) & (F.col("toxic") == 0))).cast("int"))).first()[0]
    assert right >= 0.9


def test_quality_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (9, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert classify(odd, labels).count() == len(TEXTS) + 1
    assert classify(odd, labels.where("false")).columns[-3:] == ["p_poor", "p_toxic", "keep"]


EMPTY = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "benchmark": "item_id long, text string",
         "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int",
         "labels": "doc_id long, quality int, toxic int"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(name, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for table, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(folder)).count() == 0


@pytest.mark.parametrize("which", ["odd", "small"])
@pytest.mark.parametrize("crowded", [1000, 1])
def test_substrings(which, crowded, request):
    docs = request.getfixturevalue(which)
    out = remove_repeats(docs, crowded=crowded)
    got = [(d, n, r, brute.sha(t)) for d, n, r, t in rows_of(out, "doc_id", "n_words", "n_removed", "kept_text")]
    same(got, brute.without_repeats(texts(docs)))


def test_automaton():
    import random
    rnd = random.Random(3)
    texts_ = [[rnd.choice("ab") for _ in range(rnd.randint(3, 14))] for _ in range(60)]
    automaton = Automaton()
    for n, words in enumerate(texts_):
        want = [next((m for m in range(n) if any(texts_[m][j:j + 4] == words[i:i + 4] for j in range(len(texts_[m]) - 3))), None)
                for i in range(len(words) - 3)]
        assert automaton.first_sources(words, 4) == want
        automaton.add(words, n)


def test_classes_without_ids_of_their_own(spark):
    """Two texts without an id, two texts under one id, near copies of which one has no id, and texts without words."""
    other = " ".join(f"v{i}y" for i in range(60))
    third = " ".join(f"u{i}z" for i in range(60))
    rows = [(None, PASSAGE), (None, other), (7, "one two three"), (7, "four five six"), (7, "four five six"),
            (None, third), (9, third + " more"), (8, ""), (8, " "), (None, None), (None, "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    joined = jaccard_join(docs)
    keys = {r["text_md5"]: r["class_key"] for r in joined.where("set_id is not null").collect()}
    assert len(set(keys.values())) == 5 and len(keys) == 6
    same(rows_of(keep_one(docs, joined), "doc_id", "text"), [
        (None, PASSAGE), (None, other), (7, "one two three"), (7, "four five six"), (9, third + " more"),
        (8, ""), (8, " "), (None, None), (None, "\n")])


def test_license_words_missing_from_the_corpus(spark):
    """Every copy replaces the wording's three words that no document has; 17 of 20 stand in place."""
    grant = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    changed = grant.replace("obtaining", "getting").replace("software", "program").replace("associated", "related")
    docs = spark.createDataFrame([(1, changed), (2, "before " + changed), (3, "a person")], "doc_id long, text string")
    assert sorted(rows_of(license_scan(docs), "doc_id", "labels")) == [(1, "mit"), (2, "mit"), (3, "")]
    assert {r["score"] for r in license_scan(docs).where("doc_id < 3").collect()} == {17 / len(grant.split())}
