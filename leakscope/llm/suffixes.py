"""Exact byte-substring deduplication by a distributed, common-prefix-aware
merge sort of suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts
anywhere else. Suffixes that can repeat (``repeats``) start at selected grams
that occur twice or more; each carries the bytes of its windows on both sides
of that place. A task sorts its suffixes (bytes from the gram on, then the
bytes before it backwards) into runs dealt by the gram, collapses equal ones,
and sends the runs front-coded: for every suffix the length of the prefix it
shares with the one before, and the rest, in compressed blocks. A receiving
task merges the runs of its grams with a loser tree that keeps, for every
waiting suffix, its common prefix with the last winner; two suffixes are told
apart by those lengths, and bytes are compared only beyond them. Equal
neighbours repeat as a whole. The merged order has all suffixes of one gram
together; where different ones remain, at the edges of repeats, their windows
are named by doubling and windows of one name repeat.

A crowded gram (over ``CROWDED`` occurrences) sorts by whole windows instead,
so no group grows with the number of copies beyond one row for each task.

Defined cases: null and empty texts have no bytes; a null doc_id is a document
of its own number; rows that share a doc_id are one place in the corpus, so
they do not repeat each other, and each loses the union of the found places; an
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.repeats import (candidates, covered, doc_id, keyed, per_document, runs, spans_of, units_of_bytes)
from leakscope.llm.substring import _found, deep_nodes

LENGTH = 200
GRAM = 40
CROWDED = 3000
BLOCK = 256  # suffixes in a block of a run
RUN = 40_000  # suffixes that a task sorts at a time
PART = 4 << 20  # bytes named at a time
HEAD = "<HHHHBqq"  # shared, rest, windows, place, seen twice, document, first window


def shared(a: bytes, b: bytes, h: int) -> int:
    """Length of the common prefix of a and b, of which h bytes are known."""
    n = min(len(a), len(b))
    while h < n:
        if a[h:h + 32] == b[h:h + 32]:
            h = min(n, h + 32)
            continue
        while h < n and a[h] == b[h]:
            h += 1
        break
    return h


def encode_block(items: list[tuple]) -> bytes:
    """Front-coded (suffix, meta) items: shared length, rest, meta."""
    out, last = [], b""
    for s, (d, start, n, at, many) in items:
        h = shared(last, s, 0)
        out.append(struct.pack(HEAD, h, len(s) - h, n, at, many, d, start))
        out.append(s[h:])
        last = s
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def decode_block(block: bytes):
    """(suffix, shared with the one before in the block, meta) of a block."""
    b, i, last = zstandard.ZstdDecompressor().decompress(block), 0, b""
    while i < len(b):
        h, r, n, at, many, d, start = struct.unpack_from(HEAD, b, i)
        i += struct.calcsize(HEAD)
        last = last[:h] + b[i:i + r]
        i += r
        yield last, h, (d, start, n, at, many)


def read_run(blocks: list[bytes]):
    """(suffix, shared with the one before in the run, meta)."""
    last = b""
    for block in blocks:
        first = True
        for s, h, meta in decode_block(block):
            yield s, shared(last, s, 0) if first else h, meta
            last, first = s, False


class LoserTree:
    """Merges sorted runs; each waiting suffix knows its common prefix with the
    last winner, and only bytes beyond known prefixes are compared."""

    def __init__(self, sources: list) -> None:
        self.src = [iter(s) for s in sources]
        self.k = 1
        while self.k < max(1, len(self.src)):
            self.k *= 2
        self.head: list = [next(s, None) for s in self.src] + [None] * (self.k - len(self.src))
        self.lcp = [0] * self.k
        self.loser = [0] * self.k
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, lost = self._play(a, b)
        self.loser[node] = lost
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix is then known to the winner."""
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        la, lb = self.lcp[a], self.lcp[b]
        if la != lb:  # the longer prefix with the last winner is the smaller
            return (a, b) if la > lb else (b, a)
        h = shared(x[0], y[0], la)
        if x[0][h:h + 1] <= y[0][h:h + 1]:
            self.lcp[b] = h
            return a, b
        self.lcp[a] = h
        return b, a

    def __iter__(self):
        """(suffix, common prefix with the suffix before, meta), in order."""
        while (top := self.head[self.winner]) is not None:
            w = self.winner
            yield top[0], self.lcp[w], top[2]
            self.head[w] = new = next(self.src[w], None)
            self.lcp[w] = new[1] if new else 0
            node = (w + self.k) // 2
            while node:
                won, lost = self._play(w, self.loser[node])
                self.loser[node], w = lost, won
                node //= 2
            self.winner = w


def _collapse(held: dict, suffix: bytes, meta: tuple, many: int, lost: list) -> None:
    """Keeps one place of a suffix; a second place means that both repeat."""
    old = held.get(suffix)
    if old is None:
        held[suffix] = [meta, many]
    elif many or old[0][:2] != meta[:2]:
        lost.append(meta[:3])
        if not old[1]:
            lost.append(old[0][:3])
            old[1] = 1


def _runs(batches, length: int, gram: int, parts: int):
    """Rows (part, run, nr, block, d, start, n): front-coded blocks, and windows
    already known to repeat inside the task (block null)."""
    held: dict[bytes, list] = {}
    crowds: dict[bytes, list] = {}
    lost: list[tuple] = []

    def flush():
        for text, (m, many) in crowds.items():  # whole windows
            for i in range(m[2]):
                _collapse(held, text[i:i + length], (m[0], m[1] + i, 1, 0, length), many, lost)
        dealt: dict[int, list] = {}
        for s, (m, many) in held.items():
            dealt.setdefault(xxhash.xxh3_64_intdigest(s[:m[4]]) % parts, []).append((s, (*m[:4], many)))
        held.clear()
        crowds.clear()
        run = uuid.uuid4().int >> 66
        rows = []
        for part, items in dealt.items():
            items.sort()
            rows += [(part, run, i, encode_block(items[i:i + BLOCK])) for i in range(0, len(items), BLOCK)]
        return _blocks(rows)

    def known():
        rows = [(hash(x) % parts, 0, 0, None, *x) for x in lost]
        lost.clear()
        return _blocks(rows)
    for b in batches:
        ds, texts = b.column("d").to_pylist(), b.column("text").to_pylist()
        for row, (d, text) in enumerate(zip(ds, texts)):
            t = text.encode()
            for s, n, at, crowded in zip(*(x.tolist() for x in spans_of(b, row))):
                if crowded:
                    _collapse(crowds, t[s:s + n - 1 + length], (d, s, n), 0, lost)
                else:
                    a = s + at
                    _collapse(held, t[a:s + n - 1 + length] + t[s:a][::-1], (d, s, n, at, gram), 0, lost)
            if len(held) + 50 * len(crowds) >= RUN:
                yield flush()
            if len(lost) > 50_000:
                yield known()
    yield flush()
    yield known()


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r if len(r) == 7 else (*r, None, None, None) for r in rows]
    cols = list(zip(*rows)) or [()] * 7
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      ["part", "run", "nr", "block", "d", "start", "n"])


def repeats_of_part(items: list[tuple], length: int):
    """(d, first window, windows) that repeat among different suffixes of a few
    grams. An item is (bytes in text order, d, start, n, counted twice)."""
    texts = [x[0] for x in items]
    d, start, n, many = (np.array([x[i] for x in items], np.int64) for i in (1, 2, 3, 4))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([len(t) for t in texts]) - np.array([len(t) for t in texts])
    node = deep_nodes(flat, length)
    row = np.repeat(np.arange(len(n)), n)
    off = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    node = node[begin[row] + off]
    # an item stands for one place, or for several if counted twice
    order = np.lexsort((start[row] + off, d[row], node))
    at = np.stack((node[order], d[row][order], (start[row] + off)[order]))
    new_name = np.concatenate(([True], at[0, 1:] != at[0, :-1]))
    new_place = new_name | np.concatenate(([True], (at[1:, 1:] != at[1:, :-1]).any(0)))
    group = np.cumsum(new_name) - 1
    places = np.bincount(group, new_place + many[row][order])
    twice = np.zeros(len(row), bool)
    twice[order] = places[group] > 1
    i, k = runs(row * (1 << 32) + off, twice)
    return d[row][i], (start[row] + off)[i], k


def _merge(batches, length: int, gram: int):
    """Merges the runs of each part; rows arrive ordered by part, run, number."""
    part, sources, name = None, [], None
    for b in batches:
        known = [(d, s, n) for blk, d, s, n in zip(*(b.column(c).to_pylist() for c in ("block", "d", "start", "n")))
                 if blk is None]
        if known:
            yield _found(*(np.array(c, np.int64) for c in zip(*known)))
        for p, r, blk in zip(*(b.column(c).to_pylist() for c in ("part", "run", "block"))):
            if blk is None:
                continue
            if p != part:
                if sources:
                    yield from _resolve(sources, length, gram)
                part, sources, name = p, [], None
            if r != name:
                sources.append([])
                name = r
            sources[-1].append(blk)
    if sources:
        yield from _resolve(sources, length, gram)


def _resolve(sources: list[list[bytes]], length: int, gram: int):
    whole: list[tuple] = []  # places whose windows all repeat
    group: list[list] = []  # different suffixes of one gram, as [suffix, meta, equal ones follow]
    edge: list[tuple] = []  # groups that hold more than one
    size = 0
    last = None

    def close():
        nonlocal size
        for s, m, many in group:
            if many or m[4]:
                whole.append(m[:3])
        if len(group) > 1:
            for s, m, many in group:
                cut = len(s) - m[3]
                edge.append((s[cut:][::-1] + s[:cut], *m[:3], int(many or m[4])))
                size += len(s)
    for s, h, meta in LoserTree([read_run(x) for x in sources]):
        if last is not None and h == len(s) == len(last):  # equal to the suffix before
            kept = group[-1]
            if meta[:2] != kept[1][:2]:
                kept[2] = True
                whole.append(meta[:3])
        else:
            if h < gram and group:
                close()
                group = []
                if size > PART:
                    yield _found(*repeats_of_part(edge, length))
                    edge, size = [], 0
            group.append([s, meta, False])
        last = s
        if len(whole) > 50_000:
            yield _found(*(np.array(c, np.int64) for c in zip(*whole)))
            whole.clear()
    close()
    if edge:
        yield _found(*repeats_of_part(edge, length))
    if whole:
        yield _found(*(np.array(c, np.int64) for c in zip(*whole)))


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """(d, start, n): windows of ``keyed`` documents that also start elsewhere,
    as runs of n windows from byte number start."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    rows = candidates(docs, units_of_bytes, length, gram, crowded).select("d", "text", "spans").mapInArrow(
        lambda it: _runs(it, length, gram, parts),
        "part int, run long, nr int, block binary, d long, start int, n int")
    return (rows.repartition("part").sortWithinPartitions("part", "run", "nr")
            .mapInArrow(lambda it: _merge(it, length, gram), "d long, start int, n int"))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""
    rows = keyed(docs)

    def run(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column("text").to_pylist(), b.column("found").to_pylist()):
                t = np.frombuffer(text.encode(), np.uint8)
                gone = covered(len(t), [(f["start"], f["n"]) for f in found or ()], length)
                spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
                out.append((len(t), int(gone.sum()), spans, t[~gone].tobytes()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                ["d", "n_bytes", "n_removed", "n_spans", "kept"])
    out = per_document(rows, repeated(rows, length, gram, crowded)).select("d", "text", "found").mapInArrow(
        run, "d long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(doc_id(F.col("d")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
