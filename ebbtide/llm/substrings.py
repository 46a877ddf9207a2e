"""Removal of passages that an earlier document has, by suffix automata of reference shards.

The method as named broadcasts the automaton of every shard to all documents, so its work grows with the
square of the corpus. Here a shard goes only where it can match. Every window of words chooses an anchor,
the run of five words with the smallest hash in it; equal windows choose equal anchors, so the shard of an
anchor holds all that its windows can match. Anchors of a single document are left out. A shard is the
distinct surroundings of its anchor, in the order of the first document that has them: each is streamed
through the suffix automaton of those before it, whose states know their first document, and its matching
statistics give the first document of each of its windows. The windows of an anchor with very many
different surroundings are grouped one by one instead. However crowded, an anchor has one row for each place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import buffers, carried, column, discard, ensure, quoted, slices, stored
from ebbtide.llm.wordhash import blanks, run_hashes, word_hashes, word_spans

WINDOW, ANCHOR = 13, 5
#: Different surroundings beyond which the windows of an anchor are grouped one by one.
CROWDED = 1000
#: Bits of the table that keeps most anchors of a single document out of the second shuffle, whatever their number.
FILTER_BITS = 1 << 25

find_words = re.compile(r"[^\x20\x09-\x0D]+").findall


class Automaton:
    """A suffix automaton of several word sequences that knows the first source of every substring.

    Sources must come in ascending order. A state stands for the substrings with the same end
    positions, which all begin to occur with the same source.
    """

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.source = [-1], [0], [0]
        self.last = 0

    def _state(self, length: int, source: int, to: dict, link: int) -> int:
        self.next.append(to)
        self.length.append(length)
        self.source.append(source)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, word: str, q: int) -> int:
        """The state of the longest substrings that p leads to by the word, apart from longer ones in q."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.source[q], dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[str], source: int) -> None:
        self.last = 0
        for word in words:
            p = self.last
            if (q := self.next[p].get(word)) is not None:
                self.last = self._split(p, word, q)
                continue
            new = self._state(self.length[p] + 1, source, {}, 0)
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.next[p][word])
            self.last = new

    def first_sources(self, words: list[str], size: int) -> list[int | None]:
        """For each window of ``size`` words, the first source that has it; None where none has."""
        out: list[int | None] = []
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if (to := self.next[state].get(word)) is not None:
                state, matched = to, matched + 1
            # Only the window itself counts, so a longer match gives up its oldest words.
            while self.link[state] >= 0 and self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if i >= size - 1:
                out.append(self.source[state] if matched >= size else None)
        return out


def chosen_anchors(data: np.ndarray, offsets: np.ndarray, size: int, run: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, word of the anchor, first window, windows) of every anchor; words are counted within the text."""
    data, begin, end, at = word_spans(data, offsets, blanks)
    runs = run_hashes(word_hashes(data, begin, end), run)
    place = np.arange(max(0, len(begin) - size + 1))
    width = size - run + 1
    # The smallest of each ``width`` hashes, the leftmost of equal ones, by doubling.
    best, span = np.arange(len(runs)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:len(best) - step], best[step:]
        best, span = np.where(runs[a] <= runs[b], a, b), span + step
    best = best[:len(place)]
    text = np.searchsorted(at, place, side="right") - 1
    inside = place + size <= at[text + 1] if len(place) else np.zeros(0, bool)
    place, best, text = place[inside], best[inside], text[inside]
    if not len(place):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    new = np.ones(len(place), bool)
    new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    base = at[text[first]]
    return text[first], runs[best[first]].view(np.int64), best[first] - base, place[first] - base, count


def _filter(shared: DataFrame, bits: int) -> np.ndarray:
    """A bit table of the shared anchors: bits / 32 short rows at most are collected. Other anchors that
    meet a set bit only cost time."""
    slot = F.pmod("anchor", F.lit(bits))
    words = shared.select((slot / 32).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(anchor, {bits}) % 32 as int))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[got["word"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return table


def _anchors(rows: DataFrame, size: int, run: int, known: np.ndarray | None = None) -> DataFrame:
    """(anchor, doc_id, row, window) of every anchor, or of those that the bit table may hold."""
    shared = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            text, anchor, _, window, _ = chosen_anchors(*buffers(column(piece, "text")), size, run)
            if shared is not None:
                slot = anchor % (len(shared.value) * 32)
                may = (shared.value[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1) == 1
                text, anchor, window = text[may], anchor[may], window[may]
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), column(piece, "doc_id").take(at), column(piece, "row").take(at),
                                              pa.array(window.astype(np.int32))], ["anchor", "doc_id", "row", "window"])

    return rows.mapInArrow(choose, "anchor long, doc_id long, row long, window int")


def _surroundings(rows: DataFrame, size: int, run: int) -> DataFrame:
    """(shard, key, words, doc_id, row, window): the words around each marked anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            text, anchor, _, window, count = chosen_anchors(*buffers(column(piece, "text")), size, run)
            docs, keys, marks = (column(piece, c).to_pylist() for c in ("doc_id", "row", "marks"))
            texts, out = column(piece, "text"), []
            at = np.searchsorted(text, np.arange(len(docs) + 1)).tolist()
            for i in range(len(docs)):
                wanted = set(marks[i])
                words = find_words(texts[i].as_py())
                for shard, start, n in zip(*(x[at[i]:at[i + 1]].tolist() for x in (anchor, window, count))):
                    if start in wanted:
                        out.append((shard, " ".join(words[start:start + n + size - 1]), docs[i], keys[i], start))
            if out:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 ["shard", "words", "doc_id", "row", "window"])

    cuts = rows.mapInArrow(cut, "shard long, words string, doc_id long, row long, window int")
    return cuts.withColumn("key", F.xxhash64(F.lit("key"), F.col("words")))


def _first_documents(distinct: DataFrame, size: int, crowded: int) -> DataFrame:
    """(shard, key, firsts): for each window of each surrounding, the first document that has it."""
    crowds = stored(distinct.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("shard"), "crowded")
    if crowds.isEmpty():
        return _streamed(distinct, size)
    return _streamed(distinct.join(crowds, "shard", "left_anti"), size).unionByName(
        _grouped(distinct.join(crowds, "shard", "left_semi"), size))


def _grouped(distinct: DataFrame, size: int) -> DataFrame:
    """The same by the words of each window; a window that stands in one surrounding alone meets no other row."""
    words, last = F.split("words", " "), F.size(F.split("words", " ")) - size
    passages = F.transform(F.sequence(F.lit(0), last), lambda k: F.array_join(F.slice(words, k + 1, size), " "))
    windows = distinct.select("shard", "key", "first", F.posexplode(passages).alias("at", "passage"))
    met = windows.groupBy("passage").agg(F.min("first").alias("least"), F.max("first").alias("most")).where("least < most")
    earlier = windows.join(met.select("passage", "least"), "passage").where("least < first")
    found = earlier.groupBy("shard", "key").agg(F.map_from_entries(F.collect_list(F.struct("at", "least"))).alias("found"))
    firsts = F.transform(F.sequence(F.lit(0), last), lambda k: F.coalesce(F.element_at("found", k), "first"))
    return distinct.join(found, ["shard", "key"], "left").select("shard", "key", firsts.alias("firsts"))


def _streamed(distinct: DataFrame, size: int) -> DataFrame:
    """The same by one automaton for each shard."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, automaton = None, None
        for batch in batches:
            shards, keys, firsts = column(batch, "shard").to_pylist(), column(batch, "key").to_pylist(), []
            for shard, text, first in zip(shards, column(batch, "words").to_pylist(), column(batch, "first").to_pylist()):
                if shard != current:
                    current, automaton = shard, Automaton()
                words = text.split(" ")
                found = automaton.first_sources(words, size)
                if None in found:
                    automaton.add(words, first)
                firsts.append([first if f is None else f for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(keys, pa.int64()),
                                              pa.array(firsts, pa.list_(pa.int64()))], ["shard", "key", "firsts"])

    parts = distinct.repartition("shard").sortWithinPartitions("shard", "first", "key")
    return parts.mapInArrow(stream, "shard long, key long, firsts array<long>")


def remove_repeats(docs: DataFrame, size: int = WINDOW, run: int = ANCHOR, crowded: int = CROWDED, filter_bits: int = FILTER_BITS,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text: the words, joined by one space, that no window covers
    whose words also stand together in a document of a smaller id.

    Words lie between ASCII white space. Windows have ``size`` words; shorter texts lose nothing. Windows
    are judged on the input. A null text has no words. Rows with a null id lose nothing and cost nobody
    anything. Rows that share an id never cost each other anything. An empty table gives no rows; a very long
    text is a row like any other. Columns of ``docs`` with the names of
    the new ones are replaced. Hashes of 64 bits choose anchors and tell rows of one id apart; what is
    removed is decided on the words themselves.
    """
    ensure(docs.sparkSession)
    new = ("n_words", "n_removed", "kept_text")
    kept = [f for f in docs.schema if f.name not in new]
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    rows = docs.where(f"`{doc_id}` is not null and `{text}` is not null").select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), key.alias("row"))
    places = _anchors(rows, size, run)
    shared = stored(places.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor"),
                    "shared-anchors")
    again = _anchors(rows, size, run, _filter(shared, filter_bits)).select("anchor", "row", "window")
    marks = again.join(shared, "anchor").groupBy("row").agg(
        F.collect_set("window").alias("marks"))  # no more than a text has words
    marks = stored(marks, "marks")
    cuts = stored(_surroundings(rows.join(marks, "row"), size, run), "surroundings")
    distinct = stored(cuts.groupBy("shard", "key", "words").agg(F.min("doc_id").alias("first")), "shards")
    slim = stored(cuts.select("shard", "key", "doc_id", "row", "window"), "places")
    discard(cuts)
    firsts = stored(_first_documents(distinct, size, crowded), "first-documents")
    discard(distinct)
    found = slim.join(firsts, ["shard", "key"])
    found = found.select("row", F.filter(F.transform("firsts", lambda f, k: F.when(f < F.col("doc_id"), F.col("window") + k)),
                                         lambda x: x.isNotNull()).alias("w")).where(F.size("w") > 0)
    gone = stored(found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("w"))).alias("windows")), "windows")
    user, back = carried(docs, [f.name for f in kept if f.name != text])
    joined = docs.select(user, F.col(quoted(text)).alias("text"), key.alias("row_key"))
    joined = joined.join(gone, joined["row_key"] == gone["row"], "left").select("user", "text", "windows")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            n, removed, left = [], [], []
            for value, windows in zip(column(piece, "text").to_pylist(), column(piece, "windows").to_pylist()):
                words = find_words(value) if value else []
                n.append(len(words))
                if windows:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, windows, 1)
                    np.add.at(steps, np.asarray(windows) + size, -1)
                    keep = np.cumsum(steps)[:-1] == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                removed.append(n[-1] - len(words))
                left.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [column(piece, "user"), column(piece, "text"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string())],
                ["user", "text", *new])

    schema = f"user {joined.schema['user'].dataType.simpleString()}, text string, n_words long, n_removed long, kept_text string"
    if text in [f.name for f in kept]:
        back.insert([f.name for f in kept].index(text), F.col("text").alias(text))
    return joined.mapInArrow(strip, schema).select(*back, *new)
