"""Plain single-process versions of the corpus operators, for small inputs.
A document is (doc_id, text); null ids sort first."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def ascii_lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def order(docs):
    return sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))


def earlier_windows(docs, units, length):
    """Per doc_id: unit numbers covered by a window that also starts earlier."""
    first, gone = {}, defaultdict(set)
    for d, t in order(docs):
        u = units(t)
        for p in range(len(u) - length + 1):
            k = tuple(u[p:p + length])
            if first.setdefault(k, (d, p)) != (d, p):
                gone[d].update(range(p, p + length))
    return gone


def substring(docs, length):
    gone = earlier_windows(docs, lambda t: WORD.findall(t or ""), length)
    out = []
    for d, t in docs:
        w = WORD.findall(t or "")
        kept = [x for i, x in enumerate(w) if i not in gone[d]]
        out.append((d, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def lines(docs, run, words=50):
    """Lines in a window (``run`` lines, or the fewest that hold ``words``) that also starts earlier."""
    split = [(d, t.split("\n")) for d, t in order(x for x in docs if x[1] is not None)]
    first, gone = {}, defaultdict(set)
    for d, u in split:
        for p in range(len(u)):
            short = next((m for m in range(1, run) if p + m <= len(u) and sum(x.count(" ") + 1 for x in u[p:p + m]) >= words), None)
            for m in {run, short} - {None}:
                if p + m <= len(u) and first.setdefault(tuple(u[p:p + m]), (d, p)) != (d, p):
                    gone[d].update(range(p, p + m))
    return [(d, None if t is None else [x for i, x in enumerate(t.split("\n")) if i not in gone[d]]) for d, t in docs]


def suffixes(docs, length):
    places = defaultdict(set)
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            places[b[p:p + length]].add((d, p))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if len(places[b[p:p + length]]) > 1:
                gone[p:p + length] = True
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def simhash(text, shingle=3):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return 0
    k = min(shingle, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(docs, bits=3):
    fp = [simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(docs)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= bits:
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), d), d)
    return [(d, f"{fp[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(docs)]


def contamination(docs, items, window=13):
    keys = defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall(ascii_lower(t or ""))
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            keys[tuple(w[s:s + k])].add(str(i))
    sizes = {len(k) for k in keys}
    out = []
    for d, t in docs:
        w = ITEM_WORD.findall(ascii_lower(t or ""))
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in keys:
                    hit.update(range(s, s + k))
                    found |= keys[tuple(w[s:s + k])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out
