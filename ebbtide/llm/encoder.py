"""Token ids of whole batches by the tokenizers library, one call for each distinct pre-token."""

from __future__ import annotations

import functools
import json

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

from ebbtide.llm.pretokens import specials, starts

BPE_50K = "byte_bpe_50k.json"
#: Bytes of remembered words beyond which a worker starts anew.
REMEMBERED_BYTES = 64 << 20
#: What a word costs beside its own bytes: the object, its place in the table, its number and its row.
WORD_BYTES = 150


def vocabulary_path(name: str = BPE_50K) -> str:
    return public_tokenizers.path(name)


class Remembered:
    """Ids of words, kept for as long as they stay within a bound of bytes. ``tokens`` gives those of new words."""

    def __init__(self, remembered: int = REMEMBERED_BYTES):
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int32)
        self.used = self.bytes_held = 0

    def tokens(self, words: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def _learn(self, words: list[bytes]) -> None:
        got = self.tokens(words)
        lengths = np.fromiter(map(len, got), np.int32, len(got))
        flat = np.fromiter((i for x in got for i in x), np.int32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        base = len(self.words)
        while base + len(words) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.first[base:base + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.count[base:base + len(words)] = lengths
        self.used += len(flat)
        self.bytes_held += sum(map(len, words)) + WORD_BYTES * len(words) + 4 * len(flat)
        self.words.update(zip(words, range(base, base + len(words))))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The row of each word."""
        if self.bytes_held > self.remembered:
            self._forget()
        get = self.words.get
        numbers = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            fresh = list(dict.fromkeys(words[i] for i in new.tolist()))
            self._learn(fresh)
            numbers[new] = [self.words[words[i]] for i in new.tolist()]
        return numbers

    def gather(self, number: np.ndarray, count: np.ndarray, lone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words in order, place behind each); words at ``lone`` take one place and no id."""
        stop = np.cumsum(count)
        place = np.arange(stop[-1], dtype=np.int32) - np.repeat((stop - count - self.first[number]).astype(np.int32), count)
        if lone is not None:
            place[(stop - count)[lone]] = 0
        return self.ids[place], stop


class Encoder(Remembered):
    """Byte-level BPE with remembered pre-tokens.

    Merges never cross pre-tokens, so the ids of a text are those of its pre-tokens in order. Each
    distinct pre-token goes through the library once; texts are then put together with numpy.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES):
        super().__init__(remembered)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if len(added) > 1:
            raise ValueError("only one special string is handled")
        self.special = added[0]["content"].encode() if added else b""
        self.special_id = added[0]["id"] if added else -1
        self.shown = self.shown_bytes()

    @staticmethod
    def shown_bytes() -> dict[int, str]:
        """The characters by which the vocabulary writes bytes; a lone pre-token shows the library's own map."""
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {b: c for c in range(256) for b, c in zip(chr(c).encode(), shown(chr(c))[0][0])}

    def tokens(self, words: list[bytes]) -> list[list[int]]:
        one = self.library.model.tokenize
        return [[t.id for t in one(w.decode("latin-1").translate(self.shown))] for w in words]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and their offsets."""
        begin, marked = starts(data, offsets, self.special)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        end = np.append(begin[1:], len(data))
        which, words = distinct(data, begin, end)
        number = self.numbers(words)[which]
        count = self.count[number].astype(np.int64)
        at = np.searchsorted(begin, marked)
        count[at] = 1
        ids, stop = self.gather(number, count, at)
        ids[(stop - count)[at]] = self.special_id
        edges = np.searchsorted(begin, offsets)
        return ids, np.concatenate([[0], stop])[edges]


def distinct(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each span's text, the distinct texts).

    Spans of at most 15 bytes are two words with their length in the last byte. They are sorted by a
    hash that carries their place, and compared with the first of their hash; longer spans and those
    that share a hash with another text are looked up one by one. So the result is exact.
    """
    n = len(begin)
    length = end - begin
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    words = np.ndarray(len(data) + 16, np.uint64, padded.data, strides=(1,))
    low, high = words[begin], words[begin + 8]
    keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    low &= keep[np.minimum(length, 8)]
    high &= keep[np.clip(length - 8, 0, 7)]
    high |= np.minimum(length, 255).astype(np.uint64) << np.uint64(56)
    mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ ((high ^ (high >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    bits = np.uint64(max(1, int(n).bit_length()))
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed << bits) | np.arange(n, dtype=np.uint64)
    mixed.sort()
    order = (mixed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    mixed >>= bits
    new = np.ones(n, bool)
    np.not_equal(mixed[1:], mixed[:-1], out=new[1:])
    group = np.cumsum(new) - 1
    chosen = order[new]
    which = np.empty(n, np.int64)
    which[order] = group
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(begin[chosen].tolist(), end[chosen].tolist())]
    odd = (length > 15) | (low != low[chosen][which]) | (high != high[chosen][which])
    seen: dict[bytes, int] = {}
    for i in np.flatnonzero(odd).tolist():
        word = raw[begin[i]:end[i]]
        if word not in seen:
            seen[word] = len(texts)
            texts.append(word)
        which[i] = seen[word]
    return which, texts


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker process and vocabulary."""
    return Encoder(path)
