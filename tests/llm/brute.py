"""Plain versions of the contracts, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if w and item is not None:
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                windows[tuple(w[i:i + n])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def without_repeats(docs):
    first = {}
    for doc, text in docs:
        w = blank_words(text)
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        w, gone = blank_words(text), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < doc:
                gone.update(range(i, i + 13))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def best(vectors, k=5):
    rows = [(key, np.floor(256 * np.array(v, float)).astype(np.int64)) for key, v in vectors
            if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for key, v in rows:
        if key % 50 == 0:
            scored = sorted((-int(v @ w), other) for other, w in rows if other != key and len(w) == len(v))[:k]
            out += [(key, rank, other, -s) for rank, (s, other) in enumerate(scored, 1)]
    return out


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(text):
    return tokenizer_once().encode(text or "", add_special_tokens=False).ids


def tokenizer_once(held=[]):
    if not held:
        held.append(tokenizer())
    return held[0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def base_phrases(text):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    w, places, labels = words(text), [], set()
    for p, label in phrases.items():
        p = p.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similar_documents(docs):
    """(doc, class, links) by comparing all pairs of texts that share a shingle."""
    sets = [(doc, shingles(text)) for doc, text in docs]
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    label, links = list(range(len(sets))), [0] * len(sets)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, s) in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            t = sets[j][1]
            if 9 * len(s & t) >= 4 * (len(s) + len(t)):
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, least[root(i)], links[i]) for i, (doc, _) in enumerate(sets)]


def archived(pages):
    groups = defaultdict(list)
    for page, _, html in pages:
        groups[html or ""].append(page)
    out = []
    for page, _, html in pages:
        raw = (html or "").encode()
        first = max(groups[html or ""])
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if page == first else "revisit", None if page == first else first))
    return out


def aligned(docs):
    """doc_id and the eight results, by plain loops."""
    from sentencepiece import SentencePieceProcessor

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = {c: i for i, c in shown_bytes().items()}
    out, links_of, held = [], [], defaultdict(int)
    for doc, text in docs:
        ta, tb = [], []
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            ta = [(i, bytes(shown[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
            for i in b.encode(text):
                p = b.id_to_piece(i)
                tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
            want = (" " + text).encode()
            if b"".join(t for _, t in ta) != want or b"".join(t for _, t in tb) != want:
                ta, tb = [], []
        spans = []
        for side in (ta, tb):
            at, one = 0, []
            for i, t in side:
                one.append((at, at + len(t), i))
                at += len(t)
            spans.append(one)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= c) for side in spans))
            start = c
        links, j = [], 0
        for s, e, i in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        for pair in set(links):
            held[pair] += 1
        links_of.append(links)
        out.append((doc, len(ta), len(tb), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ta else ""))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [(*r[:5], sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), r[5]) for r, links in zip(out, links_of)]


def shown_bytes():
    from tokenizers import pre_tokenizers

    shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    few = {b: c for c in range(256) for b, c in zip(chr(c).encode(), shown(chr(c))[0][0])}
    return {b: few.get(b, chr(b)) for b in range(256)}


def whitened(rows, components=16):
    """{vec_id: (deviation, whitened values)}, n, explained shares, by one dense decomposition."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centre = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, axes = np.linalg.eigh(centre.T @ centre / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    share = values / np.trace(centre.T @ centre / n)
    out = {}
    for i, v in x.items():
        apart = [n * c - s for c, s in zip(v, sums)]
        out[i] = sum(a * a for a in apart), np.array([a / n for a in apart]) @ axes / np.sqrt(np.where(values > 1e-9, values, np.nan))
    return out, n, share


def without_long_repeats(docs, size=100):
    """(doc_id, bytes, removed, spans, digest), window by window."""
    first = {}
    raws = [(d, (t or "").encode()) for d, t in docs]
    for d, raw in raws:
        for i in range(len(raw) - size + 1 if d is not None else 0):
            w = raw[i:i + size]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for d, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - size + 1 if d is not None else 0):
            if first[raw[i:i + size]] < (d, i):
                gone[i:i + size] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out
