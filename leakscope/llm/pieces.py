"""SentencePiece BPE encoding with source offsets, and decoding.

The model file is a parameter. ``Normaliser`` applies the compiled character
map (a double-array trie) by longest prefix and records for every normalised
character the source byte it starts at; ``Encoder`` merges pieces by score and
projects every piece to its original byte span. White space never stands
inside or at the end of a piece after another character, so a text falls
apart at such places into chunks that merge independently; chunks repeat, so
each worker keeps a bounded table of them. Documents are encoded where they
are read: nothing is shuffled, and a lost executor repeats its own split only.

Defined cases: a null text is encoded like an empty one (the end id only);
repeated rows give repeated results; an empty table gives an empty one; extra
columns are not read by ``encode`` and ``digests``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
MEMO = 500_000  # chunks that a worker keeps; others are encoded each time
SHORT = 32  # characters up to which a plain list beats a heap
AT_ONCE = 256  # texts of a batch that are Python strings at a time


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialised protocol buffer message."""
    def varint(i):
        v = s = 0
        while True:
            v |= (b[i] & 127) << s
            s, i = s + 7, i + 1
            if b[i - 1] < 128:
                return v, i
    i = 0
    while i < len(b):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            v, i = varint(i)
        else:
            n, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            v, i = b[i:i + n], i + n
        yield key >> 3, v


class Normaliser:
    """Character map, dummy prefix and white-space rules of a model."""

    def __init__(self, spec: bytes) -> None:
        f = dict(_fields(spec))
        self.prefix, self.trim, self.escape = (bool(f.get(k, 1)) for k in (3, 4, 5))
        blob = f.get(2, b"")
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.targets = blob[4 + size:]

    def longest(self, b: bytes, i: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest rule that starts at ``i``."""
        u, best = self.units, None
        if not u:
            return None
        at = (u[0] >> 10) << ((u[0] & 0x200) >> 6)
        for j in range(i, len(b)):
            at ^= b[j]
            if at >= len(u) or (u[at] & 0x800000FF) != b[j]:
                break
            leaf, at = u[at] & 0x100, at ^ ((u[at] >> 10) << ((u[at] & 0x200) >> 6))
            if leaf:
                best = j + 1 - i, u[at] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.targets[best[1]:self.targets.index(b"\0", best[1])]

    def __call__(self, text: str) -> tuple[str, list[int]]:
        """The normalised text and, for each of its characters and its end, the
        source byte where it starts."""
        norm, at = self.aligned(text)
        return norm, at.tolist()

    def aligned(self, text: str) -> tuple[str, np.ndarray]:
        """The same with an array."""
        if self.units or self.trim:
            norm, at = self.mapped(text)
            return norm, np.array(at, np.int64)
        # every character stands for itself: the starts of all are found at once
        b = np.frombuffer(text.encode(), np.uint8)
        at = np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))
        if self.prefix and text:
            text, at = " " + text, np.insert(at, 0, at[0])
        return text.replace(" ", SPACE) if self.escape else text, at

    def mapped(self, text: str) -> tuple[str, list[int]]:
        """The same by the map and the white-space rules, from character to
        character."""
        b, out, at, i = text.encode(), [], [], 0
        while i < len(b):
            hit = self.longest(b, i)
            n = 1 if b[i] < 128 else 2 if b[i] < 224 else 3 if b[i] < 240 else 4
            n, s = (hit[0], hit[1].decode()) if hit else (n, b[i:i + n].decode())
            out += s
            at += [i] * len(s)
            i += n
        if self.trim:  # no white space at the ends, single spaces within
            keep = [k for k, c in enumerate(out) if c != " " or k and out[k - 1] != " "]
            while keep and out[keep[0]] == " ":
                keep.pop(0)
            while keep and out[keep[-1]] == " ":
                keep.pop()
            end = at[keep[-1] + 1] if keep and keep[-1] + 1 < len(at) else len(b)
            out, at = [out[k] for k in keep], [at[k] for k in keep]
        else:
            end = len(b)
        if self.prefix and out:
            out, at = [" ", *out], [at[0], *at]
        if self.escape:
            out = [SPACE if c == " " else c for c in out]
        return "".join(out), [*at, end]


class Encoder:
    def __init__(self, model: bytes) -> None:
        pieces = []
        spec = b""
        for n, v in _fields(model):
            if n == 1:
                f = dict(_fields(v))
                pieces.append((f.get(1, b"").decode(), struct.unpack("<f", f.get(2, b"\0" * 4))[0], f.get(3, NORMAL)))
            elif n == 3:
                spec = v
        self.normalise = Normaliser(spec)
        self.pieces = pieces
        self.ids = {p: (-s, i) for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER, UNUSED)}
        self.rank, self.no_rank = {p: r for p, (r, _) in self.ids.items()}, float("inf")
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.special = {i for i, p in enumerate(pieces) if p[2] in (UNKNOWN, CONTROL, BYTE)}
        self.decimal = [str(i) for i in range(len(pieces))]
        self.unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        self.eos = next(i for i, p in enumerate(pieces) if p[0] == "</s>")
        if any(k in (USER, UNUSED) for _, _, k in pieces) or any(SPACE in p.lstrip(SPACE) for p, _, k in pieces if k == NORMAL):
            raise ValueError("a model with unused or user-defined pieces, or with a space after a letter in a piece")
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+")
        # characters that each id covers: of an unknown character's bytes the first covers it
        self.covers = np.array([len(p) if k == NORMAL else int((int(p[3:5], 16) & 0xC0) != 0x80) if k == BYTE
                                else int(k == UNKNOWN) for p, _, k in pieces], np.int64)
        self.memo: dict[str, bytes] = {}

    def merge(self, chunk: str) -> list[str]:
        """Pieces of a chunk: best score first, leftmost on a tie."""
        sym, get = list(chunk), self.ids.get
        n = len(sym)
        if n <= SHORT:
            rank, none = self.rank.get, self.no_rank
            best = [rank(a + b, none) for a, b in zip(sym, sym[1:])]
            while best and (m := min(best)) != none:
                i = best.index(m)
                sym[i:i + 2] = [sym[i] + sym[i + 1]]
                del best[i]
                if i:
                    best[i - 1] = rank(sym[i - 1] + sym[i], none)
                if i < len(best):
                    best[i] = rank(sym[i] + sym[i + 1], none)
            return sym
        nxt, prv = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r[0], i, s) for i in range(n - 1) if (r := get(s := sym[i] + sym[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, s = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] is None or j < 0 or len(sym[i]) + len(sym[j]) != len(s) or sym[i] + sym[j] != s:
                continue
            sym[i], sym[j] = s, None
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
                if r := get(t := s + sym[k]):
                    heapq.heappush(heap, (r[0], i, t))
            if (p := prv[i]) >= 0:
                if r := get(t := sym[p] + s):
                    heapq.heappush(heap, (r[0], p, t))
        return [s for s in sym if s is not None]

    def chunk_ids(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of a chunk and the characters that each covers (an unknown
        character's bytes: the first covers it, the others nothing)."""
        ids, sizes = [], []
        for s in self.merge(chunk):
            if s in self.ids:
                ids.append(self.ids[s][1])
                sizes.append(len(s))
            elif self.byte:
                b = s.encode()
                ids += [self.byte[x] for x in b]
                sizes += [len(s)] + [0] * (len(b) - 1)
            else:
                ids.append(self.unk)
                sizes.append(len(s))
        return ids, sizes

    def encode(self, text: str | None) -> tuple[list[int], list[int], list[int]]:
        """Ids with the end id, and the first and past-the-last source byte of
        each (the end id: the text's end)."""
        norm, at = self.normalise(text or "")
        ids: list[int] = []
        begin: list[int] = []
        end: list[int] = []
        pos = 0
        for c in self.chunk.findall(norm):
            i, sizes = self.chunk_ids(c)
            ids += i
            for n in sizes:
                begin.append(at[pos])
                pos += n
                end.append(at[pos])
        return [*ids, self.eos], [*begin, at[-1]], [*end, at[-1]]

    def remember(self, chunk: str) -> bytes:
        """The ids of a chunk as 32-bit numbers. What else a row needs follows
        from the ids, so a kept chunk takes a few bytes."""
        got = self.memo.get(chunk)
        if got is None:
            got = array("i", self.chunk_ids(chunk)[0]).tobytes()
            if len(chunk) < 64 and len(self.memo) < MEMO:
                self.memo[chunk] = got
        return got

    def decode(self, ids: list[int]) -> str:
        out, raw = [], b""
        if self.special.isdisjoint(ids):
            out, ids = [self.pieces[i][0] for i in ids], []
        for i in [*ids, self.eos]:
            p, _, kind = self.pieces[i]
            if kind == BYTE:
                raw += bytes([int(p[3:5], 16)])
                continue
            out.append(_lossy(raw))
            raw = b""
            out.append("" if kind == CONTROL else f" {SPACE[:0]}⁇ " if kind == UNKNOWN else p)
        s = "".join(out)
        if self.normalise.prefix and s[:1] == SPACE:
            s = s[1:]
        return s.replace(SPACE, " ")

    def digest(self, text: str | None) -> tuple[int, str, str, int]:
        """(ids, sha256 of the ids' decimals, sha256 of the decoded text, source
        bytes that the spans cover)."""
        return self.row(text)[:4]

    def row(self, text: str | None) -> tuple[int, str, str, int, str]:
        """``digest`` and the sha256 of the spans: the first and past-the-last
        source byte of every id, each as eight bytes, the lowest first."""
        norm, at = self.normalise.aligned(text or "")
        chunks = self.chunk.findall(norm)
        got = list(map(self.memo.get, chunks))
        if None in got:
            got = [self.remember(c) if g is None else g for g, c in zip(got, chunks)]
        numbers = np.frombuffer(b"".join(got), np.intc)
        sizes, ids = self.covers[numbers], numbers.tolist()
        n, s = len(ids) + 1, self.decode(ids)
        ids = [*map(self.decimal.__getitem__, ids), self.decimal[self.eos]]
        ends = np.cumsum(sizes)
        spans = np.full((n, 2), at[-1], "<i8")  # the end id stands at the end
        spans[:-1, 0], spans[:-1, 1] = at[ends - sizes], at[ends]
        # characters stand in the order of their source, so no byte counts twice
        return (n, hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(s.encode()).hexdigest(),
                int((spans[:, 1] - spans[:, 0]).sum()), hashlib.sha256(spans.tobytes()).hexdigest())


def _lossy(raw: bytes) -> str:
    """Bytes as text, each byte outside a valid character as U+FFFD."""
    out = []
    while raw:
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[:n].decode())
                raw = raw[n:]
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            raw = raw[1:]
    return "".join(out)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of ``AT_ONCE`` rows, so that a worker holds the Python strings
    of these only."""
    for b in batches:
        for low in range(0, b.num_rows, AT_ONCE):
            yield b.slice(low, AT_ONCE)


def _encoder(shared) -> Encoder:
    """One encoder and its table for each worker process, kept over its tasks
    on the worker's own copy of the broadcast."""
    enc = getattr(shared, "encoder", None)
    if enc is None:
        enc = shared.encoder = Encoder(shared.value)
    return enc


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes,
    spans_sha256."""
    shared = _share(docs, model_path)

    def run(batches):
        enc = _encoder(shared)
        for b in _parts(batches):
            rows = [enc.row(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows)) or [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes", "spans_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long, "
             "spans_sha256 string")


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, ids, begins, ends (byte spans in the source text) and
    decoded."""
    shared = _share(docs, model_path)

    def run(batches):
        enc = _encoder(shared)
        for b in _parts(batches):
            rows = [enc.encode(t) for t in b.column(1).to_pylist()]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[k] for r in rows], ints) for k in range(3)),
                 pa.array([enc.decode(r[0]) for r in rows], pa.string())],
                ["doc_id", "ids", "begins", "ends", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string")


def _share(docs: DataFrame, model_path: str):
    """The model file, read once on the driver and broadcast (a vocabulary file
    of about half a megabyte; refused over 64 MB)."""
    with open(model_path, "rb") as f:
        model = f.read(64 << 20 | 1)
    if len(model) > 64 << 20:
        raise ValueError("model file over 64 MB")
    return docs.sparkSession.sparkContext.broadcast(model)
