"""Removal of long repeated byte strings by a logarithmic family of suffix arrays.

Every string of ``size`` bytes, a window, chooses the suffix to index: the one that starts at the run of bytes with
the smallest hash in it. Equal windows choose equal places, so all matches of a window are found among the suffixes
with its run. Windows next to each other mostly choose the same suffix; an *entry* is one suffix with the stretch of
windows that chose it, and entries with the same stretch of bytes are equal.

Documents come in batches. A batch gets its suffix array: its entries, dealt by run into buckets. It is merge-scanned
against every level that stands, bucket by bucket and without a shuffle: a run that the batch has several times, or that
a level has too, may belong to a long match and is noted. Then the batch becomes a level of its own, and while the two
newest levels are of equal size, they merge. So n batches leave at most log2(n) + 1 levels, and a run is rewritten
log2(n) times at most.

Only entries of noted runs are looked at further. Equal entries decide by themselves which of them is the first. Where
the same run stands in different stretches, the texts at their first places are fetched and their windows sorted and
compared as bytes. The stretches of a run that very many have are parted first, by what their windows share beside the
run, and where even that is shared by very many, the windows themselves are grouped.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ebbtide.llm.runtime import buffers, carried, column, discard, ensure, quoted, slices, stored, without_shuffle_files
from ebbtide.llm.wordhash import FACTOR, mixed
from ebbtide.session import shared_dir

SIZE, RUN = 100, 32
#: Batches that a whole table is dealt into, by ascending id.
BATCHES = 4
#: Bytes of text for each bucket of a level.
BUCKET_BYTES = 16 << 20
#: Different stretches beyond which a run is parted, and pieces beyond which windows are grouped.
CROWDED = 1000
#: Bytes of stretches that are ranked at once.
BLOCK_BYTES = 2 << 20
#: Windows hashed at once; a longer text goes in several parts.
PART = 1 << 20
#: Bits of a place within a part; the others of a word are the hash by which a suffix is chosen.
PLACE_BITS = 24
ENTRY = "h long, c long, doc_id long, row long, start int, shape int"
COLUMNS = ("h", "c", "doc_id", "row", "start", "shape")
#: An entry's shape: its windows, and from this bit on how far behind its first window the run lies.
SHIFT = 16
#: Setting by which a task writes its few buckets side by side, without sorting for them.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
U = np.uint64


@functools.cache
def _letters() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * FACTOR)


def _longer(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of the strings that reach ``step`` bytes further, from those of both ends."""
    out = h[:len(h) - step] * FACTOR
    out += h[step:]
    out ^= out >> U(29)
    out *= U(0xBF58476D1CE4E5B9)
    return out


def hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size, in ascending order, the hash of the string of that many bytes at every place."""
    h, length, out = _letters()[data], 1, []
    for size in sizes:
        while 2 * length <= size:
            h, length = _longer(h, length), 2 * length
        out.append(_longer(h, size - length) if size > length else h)
    return out


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values next to each other."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def entries(data: np.ndarray, offsets: np.ndarray, size: int, run: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, run's hash, stretch's hash, first window within the text, windows, run behind the first window) of every entry, part by part."""
    for at in range(0, max(0, len(data) - size + 1), PART):
        part = data[at:at + PART + size - 1]
        short, long = hashes(part, run, size)
        n = len(long)
        keys = (short & ~U((1 << PLACE_BITS) - 1)) | np.arange(len(short), dtype=np.uint64)
        place = (smallest(keys, size - run + 1)[:n] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        # Windows that would reach into the next text start in the last bytes of theirs.
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, np.clip(np.maximum(offsets[1:] - size + 1, offsets[:-1]) - at, 0, n), 1)
        np.add.at(step, np.clip(offsets[1:] - at, 0, n), -1)
        inside = np.flatnonzero(np.cumsum(step[:-1]) == 0)
        if not len(inside):
            continue
        place = place[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)
        edge = np.flatnonzero(new)
        count = np.diff(np.append(edge, len(inside)))
        first = inside[edge]
        # The first and the last window cover the whole stretch.
        stretch = mixed(long[first] * FACTOR + long[first + count - 1] + count.astype(np.uint64))
        text = np.searchsorted(offsets, first + at, side="right") - 1
        yield text, short[place[edge]].view(np.int64), stretch.view(np.int64), first + at - offsets[text], count, place[edge] - first


def _entries(rows: DataFrame, size: int, run: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            for text, h, c, start, n, behind in entries(*buffers(column(piece, "text")), size, run):
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(c), column(piece, "doc_id").take(at), column(piece, "row").take(at),
                     pa.array(start.astype(np.int32)), pa.array((n | behind << SHIFT).astype(np.int32))], list(COLUMNS))

    return rows.mapInArrow(work, ENTRY)


class SuffixLevels:
    """The family: arrays of the batches, levels of runs, and the runs that the scans have noted."""

    def __init__(self, spark: SparkSession, buckets: int, size: int = SIZE, run: int = RUN):
        if not 1 <= run <= size < 1 << 15:
            raise ValueError("a run lies within a window of less than 32,768 bytes")
        self.spark, self.buckets, self.size, self.run = ensure(spark), buckets, size, run
        self.levels: list[tuple[int, DataFrame]] = []  # (batches in it, runs), the newest last
        self.arrays: list[DataFrame] = []  # entries of every batch
        self.noted: list[DataFrame] = []

    def _dealt(self, rows: DataFrame, label: str) -> DataFrame:
        """Stored in buckets by run, so that what is grouped or joined by run needs no shuffle."""
        name, path = f"{label}_{uuid.uuid4().hex}", shared_dir(self.spark, label)
        before = self.spark.conf.get(WRITERS, None)
        self.spark.conf.set(WRITERS, str(self.buckets))
        try:
            with without_shuffle_files(self.spark):
                rows.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").option("path", path).saveAsTable(name)
        finally:
            self.spark.conf.unset(WRITERS) if before is None else self.spark.conf.set(WRITERS, before)
        out = self.spark.table(name)
        out._stored_at, out._name = path, name
        return out

    def _drop(self, table: DataFrame) -> None:
        self.spark.sql(f"drop table {table._name}")
        discard(table)

    def _merge(self, a: DataFrame, b: DataFrame) -> DataFrame:
        # By path, not as bucketed tables: Spark 4.1.2 takes a union of those for grouped already.
        x, y = (self.spark.read.parquet(level._stored_at).select("h") for level in (a, b))
        out = self._dealt(x.unionByName(y).distinct(), "level")
        for level in (a, b):
            if all(level is not array for array in self.arrays):
                self._drop(level)
        return out

    def add(self, rows: DataFrame) -> None:
        """A batch: (doc_id, row, text), without nulls."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels[-2:]
            self.levels[-2:] = [(n + m, self._merge(a, b))]
        array = self._dealt(_entries(rows, self.size, self.run), "array")
        own = array.groupBy("h").agg(F.count("*").alias("k"))
        hits = [own.where("k > 1").select("h")]
        for _, level in self.levels:
            hits.append(own.select("h").join(level.select("h").hint("shuffle_hash"), "h", "left_semi"))
        self.noted.append(stored(functools.reduce(DataFrame.unionByName, hits), "noted"))
        self.arrays.append(array)
        self.levels.append((1, array))

    def _relevant(self) -> DataFrame:
        """The entries of all noted runs."""
        noted = stored(functools.reduce(DataFrame.unionByName, self.noted).distinct(), "noted-runs")
        parts = [array.join(noted.hint("shuffle_hash"), "h", "left_semi").select(*COLUMNS) for array in self.arrays]
        out = stored(functools.reduce(DataFrame.unionByName, parts), "relevant")
        discard(noted)
        return out

    def _stretches(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """``wanted`` with the bytes of each stretch, cut out of the texts."""
        size = self.size
        marks = wanted.groupBy("row").agg(F.collect_list(F.struct("h", "c", "start", "n", "behind", "crowded")).alias("marks"))  # at most one for each byte

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    text = column(batch, "text")[row].as_py().encode()
                    marks = column(batch, "marks")[row].as_py()
                    n = len(marks)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m[k] for m in marks]) for k in ("h", "c")]
                        + [pa.array([column(batch, "doc_id")[row].as_py()] * n, pa.int64()), pa.array([m["start"] for m in marks], pa.int32()),
                           pa.array([m["n"] for m in marks], pa.int32()), pa.array([m["behind"] for m in marks], pa.int32()),
                           pa.array([m["crowded"] for m in marks]),
                           pa.array([text[m["start"]:m["start"] + m["n"] + size - 1] for m in marks], pa.binary())],
                        ["h", "c", "doc_id", "start", "n", "behind", "crowded", "bytes"])

        texts = docs.dropDuplicates(["row"]).join(marks, "row").select("doc_id", "text", "marks")
        return texts.mapInArrow(cut, "h long, c long, doc_id long, start int, n int, behind int, crowded boolean, bytes binary")

    def _halves(self, crowded: DataFrame) -> DataFrame:
        """Two pieces of each stretch of a crowded run, each with ``core``: bytes that all windows of the piece share.

        A window has either the half of what it holds beside the run behind it or more than the half in front of it.
        Equal windows fall on the same side, with equal cores, which are twice as long as the run and seldom crowded.
        """
        half, run = (self.size - self.run) // 2, self.run
        # Window j of the stretch has the run ``behind - j`` bytes behind its start.
        edge = F.greatest(F.lit(0), F.least(F.col("n"), F.col("behind") - half))
        left = F.struct(F.lit(0).alias("skip"), edge.alias("m"), F.expr(f"substring(bytes, behind - {half}, {run + half + 1})").alias("core"))
        right = F.struct(edge.alias("skip"), (F.col("n") - edge).alias("m"), F.expr(f"substring(bytes, behind + 1, {run + half})").alias("core"))
        pieces = crowded.select("h", "c", "doc_id", "start", "bytes", F.explode(F.array(left, right)).alias("p")).where("p.m > 0")
        return pieces.select(
            F.xxhash64("p.core").alias("shard"), "h", "c", "doc_id", (F.col("start") + F.col("p.skip")).alias("start"), F.col("p.skip").alias("skip"),
            F.col("p.m").alias("n"), F.expr(f"substring(bytes, p.skip + 1, p.m + {self.size - 1})").alias("bytes"))

    def _equal_windows(self, stretches: DataFrame) -> DataFrame:
        """(h, c, at, m): windows of the first place of an entry that an earlier place has within another stretch."""
        size = self.size

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, bytes_held, last = [], 0, None
            for batch in batches:
                runs = column(batch, "shard").to_numpy()
                sizes = np.cumsum(column(batch, "n").to_numpy().astype(np.int64) + size - 1)
                edges = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist(), len(runs)]
                for start, edge in zip(edges, edges[1:]):
                    # A block ends where a run does, once enough is held.
                    if bytes_held >= BLOCK_BYTES and runs[start] != last:
                        yield repeated(held, size)
                        held, bytes_held = [], 0
                    held.append(batch.slice(start, edge - start))
                    bytes_held += int(sizes[edge - 1] - (sizes[start - 1] if start else 0))
                    last = runs[start]
            if held:
                yield repeated(held, size)

        plain = stretches.where("not crowded").select(F.col("h").alias("shard"), "h", "c", "doc_id", "start", F.lit(0).alias("skip"), "n", "bytes")
        halves = self._halves(stretches.where("crowded"))
        full = halves.groupBy("shard").agg(F.count("*").alias("k")).where(F.col("k") > CROWDED).select("shard")
        sorted_ones = plain.unionByName(halves.join(full, "shard", "left_anti")).repartition("shard").sortWithinPartitions("shard")
        few = sorted_ones.mapInArrow(rank, "h long, c long, at int, m int")
        windows = halves.join(full, "shard", "left_semi").select(
            "h", "c", "skip", "doc_id", "start", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
        windows = windows.select("h", "c", (F.col("skip") + F.col("j")).alias("at"), F.struct("doc_id", (F.col("start") + F.col("j")).alias("start")).alias("place"),
                                 F.expr(f"substring(bytes, j + 1, {size})").alias("w"))
        firsts = windows.groupBy("w").agg(F.min("place").alias("first"), F.count("*").alias("k")).where("k > 1")
        many = windows.join(firsts, "w").where("first < place").select("h", "c", F.col("at").cast("int"), F.lit(1).alias("m"))
        return few.unionByName(many)

    def spans(self, docs: DataFrame) -> DataFrame:
        """(row, spans): where the texts added so far repeat an earlier place; ``docs`` has (doc_id, row, text) of all of them.

        The arrays and levels are of no further use then and are deleted.
        """
        every = self._relevant()
        self.discard()
        first = F.min(F.struct("doc_id", "start", "row", "shape"))
        windows = F.col("shape").bitwiseAND((1 << SHIFT) - 1)
        known = stored(every.groupBy("h", "c").agg(first.alias("p"), F.count("*").alias("k")).select("h", "c", "p.*", "k"), "known")
        runs = known.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h", (F.col("m") > CROWDED).alias("crowded"))
        stretches = stored(self._stretches(docs, known.select(
            "h", "c", "start", "row", windows.alias("n"), F.shiftright("shape", SHIFT).alias("behind")).join(runs, "h")), "stretches")
        equal = self._equal_windows(stretches).groupBy("h", "c").agg(F.collect_list(F.struct("at", "m")).alias("spans"))
        decided = known.select("h", "c", F.struct("doc_id", "start").alias("first"), "k").join(equal, ["h", "c"], "left")
        # An entry that stands once and shares no window has nothing to say.
        decided = stored(decided.where("k > 1 or spans is not null").select("h", "c", "first", "spans"), "decided")
        discard(stretches)
        discard(known)
        whole = F.array(F.struct(F.lit(0).alias("at"), windows.alias("m")))
        found = every.join(decided, ["h", "c"]).select(
            "row", "start", F.when(F.struct("doc_id", "start") != F.col("first"), whole).otherwise(F.col("spans")).alias("spans"))
        found = found.where("spans is not null").select("row", F.expr("transform(spans, s -> struct(start + s.at as at, s.m as m))").alias("spans"))
        out = stored(found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")  # at most one for each byte of the text
        discard(every)
        discard(decided)
        return out

    def discard(self) -> None:
        """Delete the arrays, the levels and all that the scans have noted."""
        for table in {id(t): t for t in (*self.arrays, *(level for _, level in self.levels))}.values():
            self._drop(table)
        for df in self.noted:
            discard(df)
        self.arrays, self.levels, self.noted = [], [], []


def equal_numbers(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for each place in ``at``; equal for equal strings of ``size`` bytes from there on, and only for those.

    Strings are sorted by a hash and neighbours with the same hash compared byte by byte; if any two differ, all are
    ranked by their bytes instead.
    """
    h = hashes(data, size)[0][at]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twin = np.flatnonzero(same) + 1
    strings = np.lib.stride_tricks.sliding_window_view(data, size)
    for i in range(0, len(twin), 1 << 16):
        part = twin[i:i + (1 << 16)]
        if (strings[at[order[part]]] != strings[at[order[part - 1]]]).any():
            return ranks(data, at, size)
    out = np.empty(len(at), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], ~same])) if len(at) else []
    return out


def ranks(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for each place, in ``at``, by the order of the ``size`` bytes from there on: a suffix array to that depth."""
    length = 1
    rank = data.astype(np.int64)
    while 2 * length <= size:
        pairs = (rank[:len(rank) - length] << 32) | rank[length:]
        rank = np.unique(pairs, return_inverse=True)[1]
        length *= 2
    if size > length:
        pairs = (rank[at] << 32) | rank[at + size - length]
        return np.unique(pairs, return_inverse=True)[1]
    return rank[at]


def repeated(held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    """Windows, as stretches of neighbours, that stand at an earlier place too."""
    table = pa.Table.from_batches(held).combine_chunks()
    get = lambda c: table[c].to_numpy()
    h, c, doc, start, skip, n = (get(k) for k in ("h", "c", "doc_id", "start", "skip", "n"))
    n = n.astype(np.int64)
    data = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
    base = np.cumsum(n + size - 1) - (n + size - 1)
    which = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    rank = equal_numbers(data, base[which] + at, size)
    place = start[which] + at
    order = np.lexsort((place, doc[which], rank))
    r, d, p = rank[order], doc[which][order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = r[1:] != r[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = order[(d != d[first]) | (p != p[first])]
    again.sort()
    edge = np.ones(len(again), bool)
    edge[1:] = (again[1:] != again[:-1] + 1) | (which[again[1:]] != which[again[:-1]])
    begin = np.flatnonzero(edge)
    m = np.diff(np.append(begin, len(again)))
    i = which[again[begin]]
    return pa.RecordBatch.from_arrays([pa.array(h[i]), pa.array(c[i]), pa.array((skip[i] + at[again[begin]]).astype(np.int32)), pa.array(m.astype(np.int32))],
                                      ["h", "c", "at", "m"])


def remove_long_repeats(docs: DataFrame, size: int = SIZE, run: int = RUN, batches: int = BATCHES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept: the UTF-8 bytes left when every byte goes that is covered by
    a string of ``size`` bytes that also starts earlier, in a document of a smaller id or further ahead in the same.

    Overlaps count, strings are judged on the input, and no match crosses documents. ``kept`` is binary: a cut may
    fall inside a character. A null text is empty. Shorter texts lose nothing. Rows with a null id lose nothing and
    cost nobody anything. Rows that share an id count as one document: of equal strings at equal starts in them none
    is earlier, so equal rows keep the same. A very long text is hashed in parts. An empty table gives an empty result.
    Columns of ``docs`` with the names of the new ones are replaced; others come out unchanged, whatever their names.
    Hashes of 64 bits choose the suffixes and two of them tell stretches apart; windows of different stretches are
    compared as bytes.
    """
    spark = ensure(docs.sparkSession)
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    names = [c for c in docs.columns if c not in new]
    the_id, the_text = F.col(quoted(doc_id)), F.col(quoted(text))
    key = F.xxhash64(the_id, the_text)
    rows = docs.where(the_id.isNotNull() & (F.octet_length(the_text) >= size)).select(
        the_id.cast("long").alias("doc_id"), the_text.alias("text"), key.alias("row"))
    total, edges = rows.agg(F.sum(F.octet_length("text")), F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 10_000)).first() \
        if batches > 1 else (rows.agg(F.sum(F.octet_length("text"))).first()[0], [])
    index = SuffixLevels(spark, max(4, -(-(total or 0) // BUCKET_BYTES)), size, run)
    low = None
    for high in [*sorted(set(edges or [])), None]:
        part = rows
        part = part if low is None else part.where(F.col("doc_id") > low)
        index.add(part if high is None else part.where(F.col("doc_id") <= high))
        low = high
    spans = index.spans(rows)
    user, back = carried(docs, [c for c in names if c != text])
    packed = docs.select(user, the_text.alias("text"), key.alias("row_key"))
    joined = packed.join(spans, packed["row_key"] == spans["row"], "left").select("user", "text", "spans")

    def strip(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(pieces):
            data, offsets = buffers(column(piece, "text"))
            spans = column(piece, "spans")
            step = np.zeros(len(data) + 1, np.int32)
            flat = spans.flatten()
            if len(flat):
                counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
                at = flat.field("at").to_numpy() + np.repeat(offsets[:-1], counts)
                np.add.at(step, at, 1)
                np.add.at(step, at + flat.field("m").to_numpy() + size - 1, -1)
            gone = np.cumsum(step[:-1]) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            edges = offsets[:-1][offsets[:-1] < len(data)]
            first[edges] = gone[edges]
            removed, runs = (np.diff(np.concatenate([[0], np.cumsum(x)])[offsets]) for x in (gone, first))
            raw, keep, kept = data.tobytes(), ~gone, []
            for a, b, r in zip(offsets[:-1].tolist(), offsets[1:].tolist(), removed.tolist()):
                kept.append(raw[a:b] if not r else data[a:b][keep[a:b]].tobytes())
            yield pa.RecordBatch.from_arrays([column(piece, "user"), column(piece, "text"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs),
                                              pa.array(kept, pa.binary())], ["user", "text", *new])

    schema = StructType([*joined.schema.fields[:2], *(StructField(c, LongType()) for c in new[:3]), StructField("kept", BinaryType())])
    if text in names:
        back.insert(names.index(text), F.col("text").alias(text))
    return joined.mapInArrow(strip, schema).select(*back, *new)
