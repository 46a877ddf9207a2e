"""Words and hashes of runs of words, with array operations over the bytes of many texts.

A word gets a 64-bit hash of its bytes, a run of words one of its words' hashes.
"""

from __future__ import annotations

import functools

import numpy as np

FACTOR = np.uint64(0x9E3779B97F4A7C15)
U = np.uint64


@functools.cache
def letters() -> tuple[np.ndarray, np.ndarray]:
    """By byte: whether it belongs to a word of letters and digits, and its lower case (A-Z only)."""
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return inside, lower


@functools.cache
def blanks() -> tuple[np.ndarray, np.ndarray]:
    """By byte: whether it belongs to a word between white space; bytes stay as they are."""
    inside = np.ones(256, bool)
    inside[[9, 10, 11, 12, 13, 32]] = False
    return inside, np.arange(256, dtype=np.uint8)


@functools.cache
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * FACTOR)


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """FACTOR to the 0th, 1st, ... power modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        n = max(n, 1 << 20)
        _powers = np.empty(n, np.uint64)
        _powers[0] = 1
        np.multiply.accumulate(np.full(n - 1, FACTOR), out=_powers[1:])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(mapped bytes, starts, ends, offsets in words of each text)."""
    inside, to = kind()
    data = to[data]
    mask = inside[data]
    padded = np.zeros(len(data) + 2, bool)
    padded[1:-1] = mask
    first = padded[1:-1] & ~padded[:-2]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = mask[edges]
    last = padded[1:-1] & ~padded[2:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = mask[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.zeros(0, np.uint64)
    power = powers(int((end - begin).max()) + 1)
    # Position within the word gives the power, so a word's hash does not depend on where it stands.
    word = np.zeros(len(data) + 1, np.int32)
    word[begin] = 1
    word = np.cumsum(word[:-1]) - 1
    place = np.arange(len(data)) - begin[np.maximum(word, 0)]
    value = _byte_values()[data] * power[np.minimum(place, len(power) - 1)]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    return mixed(total[end] - total[begin] + (end - begin).astype(np.uint64))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` words from each position on; positions with fewer words behind them have none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * FACTOR + words[j:j + n]
    return mixed(out)
