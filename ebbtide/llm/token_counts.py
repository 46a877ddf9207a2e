"""Token counts by a compiled transducer.

Byte-level BPE of a pre-token is turned into a deterministic transducer over bytes. After a prefix
``w`` a state holds, for each start of a token that may still grow, the place in the vocabulary trie,
the last token before it, and how many tokens fewer the text up to there has. BPE has two properties
that make this enough: dropping the last token of an encoding leaves the encoding of what is left, and
a sequence is an encoding if and only if each neighbouring pair encodes to itself. So exactly one
start closes a valid token at each byte, and a transition carries the change of the token count.

States are made when first met and kept in a dense table, as a lazy automaton does. Texts are cut into
chunks of equal size that run side by side, and each chunk has a map from entry states to exit states. Where a
pre-token starts in a chunk, the map sends every entry state to one exit state. In a long word no chunk has such
a start; there the map is made for the states that can reach it: the one that the bytes before the chunk lead to
from a fresh start, for the transducer forgets what lies far behind, and any that a neighbour is found to hand
over. Chunks with equal bytes share their maps, so periodic words need few. A scan composes the maps by doubling;
where one lacks the state it is handed, that chunk runs once more. Nothing is decoded per document in Python.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.encoder import Encoder, vocabulary_path
from ebbtide.llm.pretokens import starts
from ebbtide.llm.runtime import buffers, column, ensure, slices

#: Bytes a chunk has, and states a worker keeps before it starts anew.
CHUNK = 512
STATES = 300_000
#: Bytes before a chunk that lead to the state it is probably entered in, and bytes that one table of states serves.
LEAD, SEGMENT = 192, 1 << 18
NEVER = 1 << 40
BIAS = 1024  # tokens behind may be negative


class Transducer:
    def __init__(self, path: str, chunk: int = CHUNK, states: int = STATES):
        library = Encoder(path, 0)
        self.special, self.chunk, self.most = library.special, chunk, states
        back = {c: b for b, c in library.shown.items()}
        tokens = library.library.get_vocab(with_added_tokens=False)
        with open(path, encoding="utf-8") as f:
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in json.load(f)["model"]["merges"]]
        self._trie({n: bytes(back.get(c, ord(c)) for c in text) for text, n in tokens.items()})
        self._spines(len(tokens), [(tokens[x], tokens[y], tokens[x + y]) for x, y in merges])
        self._forget()

    def _trie(self, texts: dict[int, bytes]) -> None:
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for number, raw in texts.items():
            node = 0
            for b in raw:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    token.append(-1)
                node = children[node][b]
            token[node] = number
        self.token = np.array(token, np.int64)
        self.inner = np.array([bool(c) for c in children])
        edges = sorted((node << 8 | b, to) for node, c in enumerate(children) for b, to in c.items())
        self.edge_keys, self.edge_to = np.array(edges, np.int64).T

    def _spines(self, n: int, merges: list[tuple[int, int, int]]) -> None:
        """For each token, what stands at its right and at its left end while it is merged together."""
        parts = {made: (x, y) for x, y, made in merges}
        self.rank = np.full(n, -1, np.int64)
        self.rank[[made for _, _, made in merges]] = np.arange(len(merges))
        self.spine = []
        for side in (1, 0):
            chains: list[list[int]] = []
            for t in range(n):
                chain = [t]
                while chain[-1] in parts:
                    chain.append(parts[chain[-1]][side])
                chains.append(chain[::-1])
            flat = np.array([t for c in chains for t in c], np.int64)
            size = np.array([len(c) for c in chains])
            end = np.cumsum(size)
            used = np.full(len(flat), NEVER, np.int64)  # the rank of the merge that takes it in
            used[:-1] = self.rank[flat[1:]]
            used[end - 1] = NEVER
            self.spine.append((end - size, flat, used))
        pairs = np.array([[x * n + y, k] for k, (x, y, _) in enumerate(merges)], np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.pair_keys, self.pair_rank = pairs.T.copy() if len(pairs) else (np.array([-1]), np.array([NEVER]))
        self.n = n

    def _forget(self) -> None:
        self.columns = np.full(256, -1, np.int64)
        self.n_columns = 0
        self.numbers: dict[bytes, int] = {}
        #: The starts of all states, packed: trie node, last token + 1, tokens behind.
        self.starts, self.first = np.zeros(1 << 14, np.int64), np.zeros(1025, np.int64)
        #: By state and column of a byte: the next state and the change of the count, packed; -1 if not made yet.
        self.next = np.full((1024, 64), -1, np.int32)
        self._add([np.array([BIAS]).tobytes()])

    def _add(self, states: list[bytes]) -> None:
        count = len(self.numbers)
        if count + len(states) > len(self.next):
            grow = max(len(self.next), len(states))
            self.next = np.concatenate([self.next, np.full((grow, self.next.shape[1]), -1, np.int32)])
            self.first = np.concatenate([self.first, np.zeros(grow, np.int64)])
        flat = np.frombuffer(b"".join(states), np.int64)
        used = self.first[count]
        while used + len(flat) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.starts[used:used + len(flat)] = flat
        self.first[count + 1:count + 1 + len(states)] = used + np.cumsum([len(s) // 8 for s in states])
        self.numbers.update(zip(states, range(count, count + len(states))))

    def _column(self, b: int) -> None:
        if self.columns[b] < 0:
            if self.n_columns == self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)], axis=1)
            self.columns[b] = self.n_columns
            self.n_columns += 1

    def valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the bytes of the two tokens encode to just these two tokens.

        Both are merged together side by side, the lowest rank first; a merge over the border that comes
        before what takes in either neighbour spoils the pair. Equal ranks go from left to right.
        """
        (at, flat_a, used_a), (bt, flat_b, used_b) = self.spine
        i, j = at[left], bt[right]
        good = np.ones(len(left), bool)
        live = np.arange(len(left))
        while len(live):
            a, b = i[live], j[live]
            key = flat_a[a] * self.n + flat_b[b]
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[place] == key, self.pair_rank[place], NEVER)
            ua, ub = used_a[a], used_b[b]
            bad = (rank < ua) & (rank <= ub) & (rank < NEVER)
            good[live[bad]] = False
            left_first = ua <= ub
            i[live] = a + left_first
            j[live] = b + ~left_first
            live = live[~bad & ((ua < NEVER) | (ub < NEVER))]
        return good

    def _compile(self, state: np.ndarray, byte: np.ndarray) -> None:
        """The transitions of these states by these bytes."""
        for b in np.unique(byte).tolist():
            self._column(b)
        begin, size = self.first[state], self.first[state + 1] - self.first[state]
        owner = np.repeat(np.arange(len(state)), size)
        old = self.starts[np.arange(len(owner)) - np.repeat(np.cumsum(size) - size - begin, size)]
        node, last, behind = old >> 34, (old >> 12 & 0x3FFFFF) - 1, (old & 0xFFF) - BIAS
        key = node << 8 | byte[owner]
        place = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
        on = self.edge_keys[place] == key
        owner, to, last, behind = owner[on], self.edge_to[place[on]], last[on], behind[on]
        token = self.token[to]
        closes = np.flatnonzero(token >= 0)
        free = last[closes] < 0
        closes = closes[free | self.valid(np.where(free, token[closes], last[closes]), token[closes])]
        whose = owner[closes]
        if len(closes) != len(state) or (whose != np.arange(len(state))).any():
            raise ValueError("the vocabulary has no single encoding for a text")
        change = 1 - behind[closes]
        grows = self.inner[to]
        owner, to, last, behind = owner[grows], to[grows], last[grows], (behind + change[owner])[grows]
        # The new start behind the token that just closed comes last.
        every = np.concatenate([owner, whose])
        packed = np.concatenate([to << 34 | (last + 1) << 12 | (behind + BIAS), (token[closes] + 1) << 12 | BIAS])
        order = np.argsort(every, kind="stable")
        raw, edge = packed[order].tobytes(), np.searchsorted(every[order], np.arange(len(state) + 1)) * 8
        keys = [raw[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        fresh = [k for k in dict.fromkeys(keys) if k not in self.numbers]
        if fresh:
            self._add(fresh)
        if len(change) and (change.min() < -128 or change.max() > 127) or len(behind) and (behind.min() < -BIAS or behind.max() >= 4096 - BIAS):
            raise ValueError("a token count of this vocabulary changes by more than the table holds")
        if len(self.numbers) >= 1 << 23:
            raise ValueError("more states than the table holds")
        at = self.columns[byte]
        self.next[state, at] = np.array([self.numbers[k] for k in keys]) << 8 | (change + 128)

    def _run(self, data, first, at, to, state, emitted) -> np.ndarray:
        """Run lanes from ``at`` to ``to``, entered in ``state``; the states they end in."""
        out = state.copy()
        lanes = np.flatnonzero(at < to)
        lanes = lanes[np.argsort((at - to)[lanes], kind="stable")]  # the longest first: lanes end at the back
        at, to, state = at[lanes].copy(), to[lanes], state[lanes].copy()
        ends = np.sort(to - at)
        step = 0
        while len(at):
            b = data[at]
            state[first[at]] = 0
            place = self.columns[b]
            new = self.next[state, place]
            new[place < 0] = -1
            miss = np.flatnonzero(new < 0)
            if len(miss):
                wanted = np.unique(state[miss] << 8 | b[miss])
                self._compile(wanted >> 8, wanted & 0xFF)
                new[miss] = self.next[state[miss], self.columns[b[miss]]]
            emitted[at] = (new & 0xFF) - 128
            state = (new >> 8).astype(np.int64)
            at += 1
            step += 1
            left = len(ends) - int(np.searchsorted(ends, step, side="right"))
            if left < len(at):
                out[lanes[left:len(at)]] = state[left:]
                at, state = at[:left], state[:left]
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        begin, marked = starts(data, offsets, self.special)
        first = np.zeros(len(data), bool)
        first[begin] = True
        emitted = np.zeros(len(data), np.int8)
        state = 0
        for low in range(0, len(data), SEGMENT):
            if len(self.numbers) > self.most:
                raw = self.starts[self.first[state]:self.first[state + 1]].tobytes()
                self._forget()
                if raw not in self.numbers:
                    self._add([raw])
                state = self.numbers[raw]
            state = self._segment(data, first, begin, low, min(low + SEGMENT, len(data)), state, emitted)
        if len(marked):
            for a in marked:
                emitted[a:a + len(self.special)] = 0
                emitted[a] = 1
        total = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def _segment(self, data, first, begin, low: int, high: int, state: int, emitted) -> int:
        """Run one stretch of bytes, entered in ``state``; the state it ends in."""
        edge = np.arange(low, high, self.chunk)
        end = np.minimum(edge + self.chunk, high)
        k = np.searchsorted(begin, edge)
        inner = np.where(k < len(begin), begin[np.minimum(k, len(begin) - 1)], len(data))
        inner = np.minimum(inner, end)
        exits = self._run(data, first, inner, end, np.zeros(len(edge), np.int64), emitted)
        through = inner == end
        entry = np.zeros(len(edge), np.int64)
        entry[0] = state
        entry[1:] = exits[:-1]
        if through.any():
            self._words(data, first, begin, edge, end, through, entry, exits, emitted)
        entry[1:] = exits[:-1]
        heads = np.flatnonzero(~through & (inner > edge))
        self._run(data, first, edge[heads], inner[heads], entry[heads], emitted)
        return int(exits[-1])

    def _words(self, data, first, begin, edge, end, through, entry, exits, emitted) -> None:
        """Entry and exit states of chunks without a start: maps for the states that reach them, composed in order."""
        lanes = np.flatnonzero(through)
        follows = lanes[(lanes > 0) & through[lanes - 1]]  # what is handed over is not known yet
        back = np.maximum(edge[follows] - LEAD, begin[np.searchsorted(begin, edge[follows], side="right") - 1])
        back = np.maximum(back, edge[0])
        aside = np.zeros(len(data), np.int8) if len(follows) else emitted
        entry[follows] = self._run(data, first, back, edge[follows], np.zeros(len(follows), np.int64), aside)
        exits[lanes] = self._run(data, first, edge[lanes], end[lanes], entry[lanes], emitted)
        maps = {}  # (bytes of a chunk, entry state): (exit state, where its counts stand)
        texts = {c: data[edge[c]:end[c]].tobytes() for c in lanes.tolist()}
        for c in lanes.tolist():
            maps.setdefault((texts[c], int(entry[c])), (int(exits[c]), emitted[edge[c]:end[c]].copy()))
        while True:
            # All maps at once: a chunk is settled if it is handed the state that it ran from.
            wrong = follows[exits[follows - 1] != entry[follows]]
            if not len(wrong):
                return
            # Only the first of a row of neighbours knows what it is handed for sure; the others may be right by then.
            sure = wrong[np.concatenate([[True], wrong[1:] != wrong[:-1] + 1])]
            entry[sure] = exits[sure - 1]
            new = [c for c in sure.tolist() if (texts[c], int(entry[c])) not in maps]
            if new:
                out = self._run(data, first, edge[new], end[new], entry[new], emitted)
                for c, to in zip(new, out.tolist()):
                    maps[texts[c], int(entry[c])] = to, emitted[edge[c]:end[c]].copy()
            for c in sure.tolist():
                # Known maps compose at once, chunk after chunk.
                while True:
                    exits[c], emitted[edge[c]:end[c]] = maps[texts[c], int(entry[c])]
                    if c + 1 >= len(edge) or not through[c + 1] or entry[c + 1] == exits[c] or (texts[c + 1], int(exits[c])) not in maps:
                        break
                    entry[c + 1] = exits[c]
                    c += 1


@functools.cache
def transducer(path: str) -> Transducer:
    """One for each worker process and vocabulary."""
    return Transducer(path)


def token_counts(docs: DataFrame, vocabulary: str | None = None, text: str = "text", limit: int = 1024,
                 most_bytes: int = 8 << 20) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Null and empty texts have 0 bytes and 0 tokens; an empty table gives no rows. A very long text, one long word
    too, is one stretch after the other. Each row is counted by itself, so repeated rows and
    repeated ids give as many rows. Columns of ``docs`` with the names of the new ones are replaced.
    ``vocabulary`` is a byte-level BPE file of the tokenizers library that every worker can read.
    """
    ensure(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = [f for f in docs.schema if f.name != text and f.name not in new]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", " * bool(kept) + "n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for piece in slices(batches, text, most_bytes):
            data, offsets = buffers(column(piece, text))
            n = machine.counts(data, offsets)
            rest = [column(piece, f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], [*(f.name for f in kept), *new])

    return docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{text}`")).mapInArrow(count, schema)
