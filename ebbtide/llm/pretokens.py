"""Pre-tokens of byte-level BPE, found with array operations over whole batches of texts.

The rule is the published one of the vocabulary::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

An occurrence of the special string splits a text and is a pre-token of its own, as the
tokenizers library does by default.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

OTHER, LETTER, NUMBER, BLANK, WHITE = range(5)
#: The code points of Unicode's White_Space.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: The contractions of the rule.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE_SPACE)] = WHITE
    out[32] = BLANK
    return out


def specials(data: np.ndarray, offsets: np.ndarray, special: bytes) -> np.ndarray:
    """Byte positions of the special string inside single texts."""
    found, raw, at = [], data.tobytes(), -1
    while special and (at := raw.find(special, at + 1)) >= 0:
        doc = np.searchsorted(offsets, at, side="right") - 1
        if at + len(special) <= offsets[doc + 1]:
            found.append(at)
            at += len(special) - 1
    return np.array(found, np.int64)


def starts(data: np.ndarray, offsets: np.ndarray, special: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which a pre-token starts, and those of them that are the special string."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at_byte = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(chars)
    kind = classes()[chars]
    marked = specials(data, offsets, special)
    hard = np.unique(np.concatenate([offsets[:-1], marked, marked + len(special)]))
    hard = np.searchsorted(at_byte, hard[hard < len(data)])
    first = np.zeros(n + 1, bool)  # of a text or of a piece between special strings
    first[hard] = True
    first[n] = True
    white = kind >= BLANK
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    group = np.where(white, BLANK, kind)
    start = np.empty(n + 1, bool)
    start[0] = True
    start[1:n] = group[1:] != group[:-1]
    start[n] = True
    start |= first
    # A blank before something is the first character of what follows.
    start[:n] &= ~(~white & (before == BLANK) & ~first[:n])
    # The last white character before something stands alone or goes with what follows.
    end = np.empty(n, bool)
    end[:-1] = white[:-1] & ~white[1:] & ~first[1:n]
    end[-1] = False
    start[:n] |= end
    apostrophes = np.flatnonzero((chars == 39) & start[:n])
    if len(apostrophes):
        padded = np.concatenate([chars, np.zeros(3, np.uint32)])
        near = np.concatenate([first, np.ones(3, bool)])
        for tail in CONTRACTIONS:
            hit = np.ones(len(apostrophes), bool)
            for k, c in enumerate(tail, 1):
                hit &= (padded[apostrophes + k] == ord(c)) & ~near[apostrophes + k]
            got = apostrophes[hit]
            start[got + 1] = False
            start[np.minimum(got + 1 + len(tail), n)] = True
    special_chars = np.searchsorted(at_byte, marked)
    for a in special_chars:
        start[a + 1:a + len(special)] = False
    return at_byte[np.flatnonzero(start[:n])], marked
