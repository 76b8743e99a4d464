"""Substring deduplication with prefix-partitioned suffix trees over words.

Every word that lies in a window of ``length`` words whose sequence also starts
earlier is removed. Suffixes that can repeat (``repeats``) are grouped by
a prefix of variable length: the selected gram where it is rare, the whole
window where the gram is crowded. Before the exchange each task keeps, of
equal stretches, the earliest only and reports the others at once, so a group
holds at most one row of a window for each task, however many copies there
are. Groups arrive ordered by prefix and are cut into memory-sized parts
between prefixes. The suffix trees of a part are named level by level: a node of
depth 2k is a pair of nodes of depth k, until nodes of depth ``length`` stand
for the repeats; of each such node's leaves the earliest start stays.

Defined cases: null and empty texts have no words; a null doc_id sorts before
all others; rows that share a doc_id have the same places, an equal window at
the same place is not earlier, and each such row loses the union of the found
places; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.repeats import (candidates, covered, doc_id, keyed, per_document, runs, spans_of, units_of_words)

LENGTH = 20
GRAM = 6
CROWDED = 1000  # occurrences of a gram above which the prefix is the whole window
PART = 1 << 20  # words named at a time

FOUND = "key long, d long, start int, n int, words binary"


def _earliest(kept: dict, part: bytes, place: tuple[int, int, int], lost: list) -> None:
    """Keeps the earliest place of equal stretches; the others are lost."""
    old = kept.get(part)
    if old is None or place < old:
        kept[part] = place
        if old and old[:2] != place[:2]:
            lost.append(old)
    elif place[:2] != old[:2]:
        lost.append(place)


def _stretches(batches, length: int, gram: int):
    """Tree rows (key, d, start, n, words) of a task, and rows without words
    for windows that have an earlier equal one in the task."""
    rare: dict[bytes, tuple] = {}
    crowds: dict[bytes, tuple] = {}
    place_of_gram: dict[bytes, int] = {}
    lost: list[tuple] = []

    def known():
        rows = [(hash(x), *x, None) for x in lost]
        lost.clear()
        return _rows(rows)
    for b in batches:
        ds, texts = b.column("d").to_pylist(), b.column("text").to_pylist()
        for row, (d, text) in enumerate(zip(ds, texts)):
            words = text.encode().split()
            for s, n, at, crowded in zip(*(x.tolist() for x in spans_of(b, row))):
                part = b" ".join(words[s:s + n - 1 + length])
                _earliest(crowds if crowded else rare, part, (d, s, n), lost)
                if not crowded:
                    place_of_gram[part] = at
        if len(lost) > 100_000:
            yield known()
    whole: dict[bytes, tuple] = {}
    for part, (d, s, n) in crowds.items():  # the prefix is the whole window
        words = part.split(b" ")
        for i in range(n):
            _earliest(whole, b" ".join(words[i:i + length]), (d, s + i, 1), lost)
    yield known()
    rows = []
    for part, x in rare.items():
        at = place_of_gram[part]
        rows.append((b" ".join(part.split(b" ", at + gram)[at:at + gram]), x, part))
    rows += [(part, x, part) for part, x in whole.items()]
    for i in range(0, len(rows), 20_000):
        yield _rows([(xxhash.xxh3_64_intdigest(k) >> 1, *x, part) for k, x, part in rows[i:i + 20_000]])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["key", "d", "start", "n", "words"])


def deep_nodes(units: np.ndarray, length: int) -> np.ndarray:
    """Number of the tree node of depth ``length`` at each place (shorter by
    length - 1): equal numbers for equal sequences."""
    node, depth = units.astype(np.int64), 1
    while depth < length and len(node) > min(depth, length - depth):
        step = min(depth, length - depth)
        pair = node[:-step] * (int(node.max()) + 1) + node[step:]
        node, depth = np.unique(pair, return_inverse=True)[1].astype(np.int64), depth + step
    return node


def repeats_of_part(d: np.ndarray, start: np.ndarray, n: np.ndarray, words: list[bytes], length: int):
    """(d, first window, windows) of the windows of some tree rows whose
    sequence starts earlier among them."""
    split = [w.split(b" ") for w in words]
    names: dict[bytes, int] = {}
    flat = np.array([names.setdefault(x, len(names)) for s in split for x in s], np.int64)
    ends = np.cumsum([len(s) for s in split])
    node = deep_nodes(flat, length)
    begin = ends - (n + length - 1)
    row = np.repeat(np.arange(len(n)), n)
    off = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    node = node[begin[row] + off]
    d2, p = d[row], start[row] + off
    order = np.lexsort((p, d2, node))
    head = np.concatenate(([True], node[order][1:] != node[order][:-1]))
    first = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    late = np.zeros(len(row), bool)
    late[order] = (d2[order] != d2[first]) | (p[order] != p[first])
    i, k = runs(row * (1 << 32) + off, late)
    return d2[i], p[i], k


def _trees(batches, length: int):
    held: list[tuple] = []
    size = 0

    def done(rows):
        d, s, n = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        d, s, n = repeats_of_part(d, s, n, [r[4] for r in rows], length)
        return _found(d, s, n)
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in b.columns)))
        out = [r for r in rows if r[4] is None]
        if out:
            yield _found(*(np.array([r[i] for r in out], np.int64) for i in (1, 2, 3)))
        for r in rows:
            if r[4] is None:
                continue
            if size > PART and held and held[-1][0] != r[0]:
                yield done(held)
                held, size = [], 0
            held.append(r)
            size += r[3] + length
    if held:
        yield done(held)


def _found(d, s, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())],
                                      ["d", "start", "n"])


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """(d, start, n): windows of ``keyed`` documents whose sequence also starts
    earlier, as runs of n windows from word number start."""
    rows = candidates(docs, units_of_words, length, gram, crowded).select("d", "text", "spans").mapInArrow(
        lambda it: _stretches(it, length, gram), FOUND)
    return (rows.repartition("key").sortWithinPartitions("key")
            .mapInArrow(lambda it: _trees(it, length), "d long, start int, n int"))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words that stay, joined by
    one space)."""
    rows = keyed(docs)

    def run(batches):
        for b in batches:
            n, gone, kept = [], [], []
            for text, found in zip(b.column("text").to_pylist(), b.column("found").to_pylist()):
                words = text.encode().split()
                out = covered(len(words), [(f["start"], f["n"]) for f in found or ()], length)
                n.append(len(words))
                gone.append(int(out.sum()))
                kept.append(b" ".join(w for w, o in zip(words, out.tolist()) if not o).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["d", "n_words", "n_removed", "kept"])
    out = per_document(rows, repeated(rows, length, gram, crowded)).select("d", "text", "found").mapInArrow(
        run, "d long, n_words long, n_removed long, kept string")
    return out.select(doc_id(F.col("d")).alias("doc_id"), "n_words", "n_removed", "kept")


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
