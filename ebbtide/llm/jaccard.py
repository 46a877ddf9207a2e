"""N-gram Jaccard join by chosen paths.

A document is its set of five-word shingles; documents with the same set are one class. Sets are embedded
by minwise hashing, so that two sets share a token, a component of their signatures, with the probability
of their similarity. Starting from several runs, sets are split into buckets by shared tokens: every set
goes to the bucket of the token that the path chooses. A small bucket is compared by brute force on
signatures; a large one is split further by tokens chosen on its path. The number of runs follows from
the target recall: with similarity s and c tokens chosen at a split, a path survives all splits with
probability 1 - q, where q = (1 - s (1 - q)) ** c.

Buckets only propose which sets may be similar, as edges of a graph with at most one row for each member
of a bucket. The pairs within each connected part of that graph are then compared exactly, in blocks, and
only counts and one edge for each member leave a block, so no pair is ever written as a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import buffers, carried, column, ensure, marked, slices, stored
from ebbtide.llm.wordhash import FACTOR, letters, mixed, run_hashes, word_hashes, word_spans

SHINGLE, SIMILAR = 5, (4, 5)
#: Components of a signature, tokens chosen at each later split, splits before the rest is taken as one part.
TOKENS, CHOSEN, DEPTH = 64, 2, 3
#: Chance with which a pair at the threshold may be missed, sets a bucket may hold unsplit, sets in a block.
MISS, BUCKET, BLOCK = 1e-5, 2048, 512
#: Share of equal components that makes a pair worth an exact look: five standard deviations below 0.8.
WORTH = 0.55


def runs(similar: float, miss: float = MISS, chosen: int = CHOSEN) -> int:
    """Runs that find a pair of that similarity but for a chance of ``miss``."""
    q = 0.0
    for _ in range(200):
        q = (1 - similar * (1 - q)) ** chosen
    survive = similar * (1 - q)
    return max(1, math.ceil(math.log(miss) / math.log(1 - survive)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than ``k`` words are one shingle, no words none."""
    data, begin, end, at = word_spans(data, offsets, letters)
    words = word_hashes(data, begin, end)
    whole = run_hashes(words, k)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(whole[a:b - k + 1]))
        else:
            out.append(run_hashes(words[a:b], b - a) if b > a else whole[:0])
    return out


def signatures(sets: list[np.ndarray], tokens: int, seed: int = 1) -> np.ndarray:
    """Minwise values, a row of ``tokens`` for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), tokens), np.uint64)
    for t in range(tokens):
        salt = mixed(np.array([seed * 1000 + t], np.uint64) * FACTOR)[0]
        out[:, t] = np.minimum.reduceat((flat ^ salt) * (salt | np.uint64(1)), starts)
    return mixed(out)


def _summary(docs: DataFrame, n_runs: int) -> DataFrame:
    """(doc_id, text_md5, id, n, roots, tokens) of each row: the id stands for the set, null for an empty one."""
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "text")
    names = ["doc_id", "text_md5", "id", "n", "roots", "tokens"]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(*buffers(column(piece, "text")))
            full = [s for s in sets if len(s)]
            signs = signatures(full, n_runs + TOKENS) if full else np.zeros((0, n_runs + TOKENS), np.uint64)
            roots, tokens = signs[:, :n_runs].copy().view(np.int64), (signs[:, n_runs:] & np.uint64(0xFFFF)).astype("<u2")
            rows, at = {n: [] for n in names[2:]}, 0
            for s in sets:
                rows["n"].append(len(s))
                if len(s):
                    rows["id"].append(hashlib.md5(s.tobytes()).digest())
                    rows["roots"].append(roots[at])
                    rows["tokens"].append(tokens[at].tobytes())
                    at += 1
                else:
                    for c in ("id", "roots", "tokens"):
                        rows[c].append(None)
            yield pa.RecordBatch.from_arrays([
                column(piece, "doc_id").cast(pa.int64()), column(piece, "text_md5"), pa.array(rows["id"], pa.binary()),
                pa.array(rows["n"], pa.int64()), pa.array(rows["roots"], pa.list_(pa.int64())), pa.array(rows["tokens"], pa.binary())], names)

    return rows.mapInArrow(summarise, "doc_id long, text_md5 string, id binary, n long, roots array<long>, tokens binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from rows that come sorted by them."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        columns = [column(batch, k).to_pylist() for k in keys]
        at = 0
        for i, key in enumerate(zip(*columns)):
            if key != current:
                if i > at:
                    held.append(batch.slice(at, i - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, at, current = [], i, key
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def parts_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's connected part."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _propose(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between sets of the same bucket that look similar; a row for each member at most."""

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket"]):
            ids, n = group["id"].to_pylist(), len(group)
            if n < 2:
                continue
            tokens = np.frombuffer(b"".join(group["tokens"].to_pylist()), "<u2").reshape(n, TOKENS)
            least, a, b = math.ceil(WORTH * TOKENS), [], []
            columns = np.ascontiguousarray(tokens.T)
            for at in range(0, n, 256):
                equal = np.zeros((min(256, n - at), n), np.uint8)
                for c in columns:
                    equal += c[at:at + 256, None] == c[None, :]
                x, y = np.nonzero(equal >= least)
                a.append(x + at)
                b.append(y)
            label = parts_of(n, np.concatenate(a), np.concatenate(b))
            linked = np.flatnonzero(label != np.arange(n)).tolist()
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in linked], pa.binary()),
                                                  pa.array([ids[label[i]] for i in linked], pa.binary())], ["a", "b"])

    parts = rows.select("bucket", "id", "tokens").repartition("bucket").sortWithinPartitions("bucket", "id")
    return parts.mapInArrow(brute, "a binary, b binary")


def _split(rows: DataFrame) -> DataFrame:
    """(bucket, id, tokens) -> the buckets of the next split, by the tokens that each bucket's path chooses."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = column(batch, "bucket").to_numpy().view(np.uint64)
            tokens = np.frombuffer(b"".join(column(batch, "tokens").to_pylist()), "<u2").reshape(len(batch), TOKENS)
            for c in range(CHOSEN):
                step = mixed(path + np.uint64(c + 1) * FACTOR)
                value = tokens[np.arange(len(batch)), (step % np.uint64(TOKENS)).astype(np.int64)]
                bucket = mixed(step ^ (value.astype(np.uint64) * FACTOR)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), column(batch, "id"), column(batch, "tokens")], ["bucket", "id", "tokens"])

    return rows.select("bucket", "id", "tokens").mapInArrow(split, "bucket long, id binary, tokens binary")


def connected(edges: DataFrame) -> DataFrame:
    """(id, part) for every node of the edges (a, b); the part is its smallest node.

    Large-star and small-star steps in turn until nothing changes; each step groups with map-side minima.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")).toDF("u", "v") if large else e.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m").toDF("a", "b"))
        return out.where("a <> b").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = stored(star(star(edges, True), False), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("part")).union(
        edges.select("b", "b")).groupBy("id").agg(F.min("part").alias("part"))


def _candidates(sets: DataFrame, n_runs: int, bucket: int) -> DataFrame:
    """Edges between sets that some bucket holds together and that look similar."""
    level = sets.select("id", F.posexplode("roots").alias("run", "value")).select(F.xxhash64("run", "value").alias("bucket"), "id")
    sizes = level.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    level = stored(level.join(sizes, "bucket").join(sets.select("id", "tokens"), "id"), "buckets")
    edges = _propose(level.where(F.col("size") <= bucket))
    large = level.where(F.col("size") > bucket)
    for _ in range(DEPTH):
        if large.isEmpty():
            return edges
        level = stored(_split(large), "splits")
        sizes = level.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        level = stored(level.join(sizes, "bucket"), "buckets")
        edges = edges.union(_propose(level.where(F.col("size") <= bucket)))
        large = level.where(F.col("size") > bucket)
    # What no split makes smaller is compared exactly as a whole, block by block.
    least = large.groupBy("bucket").agg(F.min("id").alias("b"))
    return edges.union(large.join(least, "bucket").select(F.col("id").alias("a"), "b"))


def _compare(members: DataFrame, shingles: DataFrame, similar: tuple[int, int], block: int) -> DataFrame:
    """(id, near, links, copies): exact comparison within parts. ``near`` ties a set to the part of its block
    that it is linked with; ``links`` counts linked sets and ``linked`` the documents in them."""
    sizes = members.groupBy("part").agg(F.count("*").alias("size"))
    rows = members.join(sizes, "part").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(shingles, "id")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "copies", "shingles")
    num, den = similar

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["part", "i", "j"]):
            n = len(group)
            if n < 2:
                continue
            i, j, own = group["i"][0].as_py(), group["j"][0].as_py(), group["own"].to_numpy()
            ids, copies = group["id"].to_pylist(), group["copies"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            shared = _overlaps(sets, sizes)
            alike = shared * (num + den) >= num * (sizes[:, None] + sizes[None, :])
            np.fill_diagonal(alike, False)
            if i != j:
                alike &= own[:, None] != own[None, :]
            some = np.flatnonzero(alike.any(axis=1))
            if not len(some):
                continue
            label = parts_of(n, *np.nonzero(alike))
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[k] for k in some], pa.binary()), pa.array([ids[label[k]] for k in some], pa.binary()),
                pa.array(alike[some].sum(axis=1).astype(np.int64)), pa.array((alike[some] @ copies).astype(np.int64))],
                ["id", "near", "links", "linked"])

    parts = rows.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "id")
    return parts.mapInArrow(compare, "id binary, near binary, links long, linked long")


def _overlaps(sets: list[np.ndarray], sizes: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many elements each two of the sets share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), sizes)
    values, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    common = count[number] > 1
    owner, number = owner[common], rank[number[common]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    for low in range(0, int(rank[-1]) + 1 if len(rank) else 0, width):
        a, b = np.searchsorted(number, [low, low + width])
        held = np.zeros((n, width), np.float32)
        held[owner[a:b], number[a:b] - low] = 1
        out += held @ held.T
    return out.astype(np.int64)


def jaccard_join(docs: DataFrame, similar: tuple[int, int] = SIMILAR, miss: float = MISS, bucket: int = BUCKET,
                 block: int = BLOCK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_md5, class_id, class_key, set_id, n_shingles, n_copies, n_links) for every row of ``docs``.

    ``n_links`` counts the other rows whose shingle set is similar (Jaccard at least ``similar``, compared
    exactly), copies included; ``n_copies`` those with the same set. ``class_id`` is the smallest doc_id
    that is reached over links. A pair at the threshold is missed with a chance of at most ``miss``, a
    more similar one with less. Texts of one to four words are one shingle; texts without words, null
    ones too, have no set and no links and are a class of their own id. Repeated rows count as copies. A
    null doc_id is a class id only where all of the class are null. Where ids repeat or are null, unrelated
    classes can have the same id; ``class_key``, the smallest set id of the class, tells them apart and is
    null without a set. Other columns are left out. 64-bit hashes stand for shingles.
    """
    ensure(docs.sparkSession)
    n_runs = runs(similar[0] / similar[1], miss)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = stored(_summary(docs, n_runs), "sets")
    sets = rows.where("id is not null").groupBy("id").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.min(F.struct("tokens", "roots")).alias("s"))
    sets = stored(sets.select("id", "first", "copies", "s.tokens", "s.roots"), "distinct-sets")
    members = stored(connected(_candidates(sets, n_runs, bucket)), "parts")

    # The texts of the sets in question, by the id of a document that has the set.
    wanted = stored(members.join(sets.select("id", "first", "copies"), "id").select("id", "first", "copies"), "wanted")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = [s for s in shingle_sets(*buffers(column(piece, "text"))) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(s.tobytes()).digest() for s in found], pa.binary()),
                                              pa.array([s.tobytes() for s in found], pa.binary())], ["id", "shingles"])

    firsts = wanted.select("first").distinct()
    near = marked(docs, F.xxhash64("doc_id"), wanted.select(F.xxhash64("first").alias("key"))).where("may")
    texts = near.join(firsts, near["doc_id"].eqNullSafe(firsts["first"]), "left_semi").select("text")
    shingles = texts.mapInArrow(gather, "id binary, shingles binary").dropDuplicates(["id"])
    shingles = stored(shingles.join(wanted.select("id", "copies"), "id"), "shingles")
    compared = stored(_compare(members, shingles, similar, block), "compared")
    counts = compared.groupBy("id").agg(F.sum("linked").alias("linked"))
    parts = connected(compared.select(F.col("id").alias("a"), F.col("near").alias("b")))
    named = parts.join(sets.select("id", "first"), "id")
    named = named.join(named.groupBy("part").agg(F.min("first").alias("class_id")), "part").select("id", "class_id", "part")
    known = stored(sets.join(named, "id", "left").join(counts, "id", "left").select(
        "id", F.coalesce("class_id", "first").alias("class_id"), "part", "copies", F.coalesce("linked", F.lit(0)).alias("linked")), "classes")
    return rows.select("doc_id", "text_md5", "id", "n").join(known, "id", "left").select(
        "doc_id", "text_md5", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.hex(F.coalesce("part", "id")).alias("class_key"), F.hex("id").alias("set_id"), F.col("n").alias("n_shingles"), F.coalesce(F.col("copies") - 1, F.lit(0)).alias("n_copies"),
        F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """One row of each class of ``jaccard_join``: that of the smallest doc_id, then of the smallest text digest.

    A null doc_id comes after all others. Rows that repeat both are reduced to one.
    """
    alone = F.when(F.col("set_id").isNull(), F.struct("doc_id", "text_md5")).alias("alone")
    best = joined.groupBy("class_key", alone).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_md5")).alias("best"))
    rows = joined.groupBy("doc_id", "text_md5").agg(F.count("*").alias("rows"))
    chosen = best.select("best.doc_id", "best.text_md5").distinct().withColumn("chosen", F.lit(True))
    both = rows["doc_id"].eqNullSafe(chosen["doc_id"]) & (rows["text_md5"] == chosen["text_md5"])
    found = rows.join(chosen, both, "left").select(rows["doc_id"].alias("_id"), rows["text_md5"].alias("_md5"), "rows", "chosen")
    # Most rows stay and are alone; only the others are looked up, and the texts of most rows are never shuffled.
    odd = stored(found.where("chosen is null or rows > 1"), "not-kept")
    user, back = carried(docs, docs.columns)
    keyed = docs.select(user, F.col("doc_id").cast("long").alias("the_id"), F.md5(F.coalesce("text", F.lit(""))).alias("_text"))
    keyed = marked(keyed, F.xxhash64("the_id", "_text"), odd.select(F.xxhash64("_id", "_md5").alias("key")))
    asked = keyed.where("may")
    met = asked.join(odd, asked["the_id"].eqNullSafe(odd["_id"]) & (asked["_text"] == odd["_md5"]), "left")
    alone = keyed.where("not may").select("user").unionByName(met.where("_md5 is null").select("user"))
    repeated = met.where("chosen").dropDuplicates(["_id", "_text"]).select("user")
    return alone.unionByName(repeated).select(*back)
