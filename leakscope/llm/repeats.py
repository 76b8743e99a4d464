"""Where equal windows can be: selected grams, shared by the two substring
operators.

A sequence of units (words or bytes) is covered by windows of ``length``
units. Every window selects the minimum of its ``gram``-unit hashes (the
rightmost on a tie), so equal windows select equal grams at equal distance,
and a window whose selected gram occurs once cannot repeat. Consecutive
windows that select the same gram are one row: about two rows for each
``length - gram`` units.

``candidates`` returns, per document, the selected grams that occur twice or
more. A document's text is dealt once by doc_id and used again for the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import written

NO_ID = -(1 << 63)
ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE_CODES = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) | 1 for b in range(256)], np.uint64)


def keyed(docs: DataFrame) -> DataFrame:
    """(d, text): doc_id with null as the smallest number, null text as empty."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"),
                       F.coalesce("text", F.lit("")).alias("text"))


def doc_id(d: Column) -> Column:
    return F.when(d != NO_ID, d)


SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SEGMENT = 1 << 21  # bytes hashed at a time
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int, known: dict = {}) -> np.ndarray:  # noqa: B006 - grows to one segment
    if len(known.get(base, ())) < n:
        known[base] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n, SEGMENT), base))), dtype=np.uint64)
    return known[base][:n]


def word_codes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word flat[start:end]: a polynomial over its bytes, taken as
    a difference of running sums."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
        low = starts[i]
        part = BYTE_CODES[flat[low:ends[j - 1]]]
        sums = np.concatenate(([np.uint64(0)], np.cumsum(part * _powers(ODD, len(part)), dtype=np.uint64)))
        own = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * _powers(INVERSE, len(part) + 1)[starts[i:j] - low]
        own ^= own >> np.uint64(32)
        out[i:j] = own * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return out


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` units from each place; shorter by gram - 1."""
    done, size, part, have, power = 0, 1, codes, None, ODD
    with np.errstate(over="ignore"):
        while True:  # binary: runs of 1, 2, 4, ... units, joined where gram has the bit
            if gram & size:
                n = len(codes) - done - size + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                have = part[:n].copy() if have is None else have[:n] * power + part[done:done + n]
                done += size
            if 2 * size > gram:
                break
            part = part[:-size] * (power * power) + part[size:]
            power = power * power * ODD
            size *= 2
        have ^= have >> np.uint64(31)
        have *= np.uint64(0xBF58476D1CE4E5B9)
        have ^= have >> np.uint64(29)
    return have


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the rightmost minimum of each ``width`` consecutive values
    (under 2^32): minima from the left and from the right within blocks of
    ``width``, of which every window spans two at most."""
    n = len(values)
    last = np.uint64(0xFFFFFFFF)
    key = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    key[:n] = values << np.uint64(32) | (last - np.arange(n, dtype=np.uint64))
    block = key.reshape(-1, width)
    left = np.minimum.accumulate(block, axis=1).ravel()
    right = np.ascontiguousarray(np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1]).ravel()
    best = np.minimum(right[:n - width + 1], left[width - 1:n])
    return (last - (best & last)).astype(np.int64)


def selected(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(gram hash, document number, first window, windows, gram's place in the
    first window) of each run of windows with one selection; places are
    counted from the document's begin."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    g = gram_hashes(codes, gram)
    width = length - gram + 1
    if len(g) < width:
        return none
    at = sliding_min(g >> np.uint64(32), width)
    size = ends - begins
    whole = np.maximum(0, size - length + 1)  # windows that end within their document
    inside = np.repeat(np.tile([True, False], len(size)), np.stack((whole, size - whole), 1).ravel())[:len(at)]
    own = np.flatnonzero(inside)
    if not len(own):
        return none
    at = at[own]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (own[1:] != own[:-1] + 1))))
    doc = np.searchsorted(ends, own[new], side="right")
    n = np.diff(np.append(new, len(own)))
    at, first = at[new], own[new]
    return g[at].view(np.int64), doc, first - begins[doc], n, at - first


def units_of_words(texts: list[bytes]):
    flat = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edge = np.diff(np.concatenate(([True], SPACES[flat])).astype(np.int8))  # -1 where a word begins, 1 behind it
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    limits = np.cumsum([len(t) + 1 for t in texts])
    ends = np.searchsorted(starts, limits)
    return word_codes(flat, starts, stops), np.concatenate(([0], ends[:-1])).astype(np.int64), ends.astype(np.int64)


def units_of_bytes(texts: list[bytes]):
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    return BYTE_CODES[np.frombuffer(b"".join(texts), np.uint8)], ends - sizes, ends


def portions(batch: pa.RecordBatch, most: int = 2 << 20):
    """(first row, texts as bytes) of parts of a batch of about ``most`` bytes."""
    texts, first, size = [], 0, 0
    for i, t in enumerate(batch.column("text").cast(pa.binary())):
        texts.append(t.as_py())
        size += len(texts[-1])
        if size >= most:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def candidates(docs: DataFrame, units, length: int, gram: int, many: int) -> DataFrame:
    """(d, text, spans): documents of ``keyed`` rows with windows that may
    repeat; spans holds (first window, windows, place of the gram, crowded: the
    gram occurs over ``many`` times)."""
    def run(batches):
        for b in batches:
            d = b.column("d").to_numpy()
            for first, texts in portions(b):
                g, doc, start, n, at = selected(*units(texts), length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g), pa.array(d[first + doc]), pa.array(start << 16 | n << 8 | at)], ["g", "d", "span"])

    rows = docs.mapInArrow(run, "g long, d long, span long")
    # counts meet one row for each gram and task; the table of repeated grams is
    # written, so the join to it stands between two plain exchanges and a very
    # common gram is split over tasks
    twice = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("g", (F.col("n") > many).alias("crowded")), "repeated-grams")
    spans = (rows.join(twice, "g")
             .groupBy("d").agg(F.collect_list(F.struct("span", "crowded")).alias("spans")))
    return docs.join(spans.hint("merge"), "d")


def spans_of(batch: pa.RecordBatch, row: int):
    """(first window, windows, place of the gram, crowded) arrays of a row,
    repeated rows of a document counted once."""
    s = batch.column("spans")[row].values
    v, i = np.unique(s.field("span").to_numpy(), return_index=True)
    return v >> 16, v >> 8 & 255, v & 255, s.field("crowded").to_numpy(zero_copy_only=False)[i]


def runs(first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers where runs of kept, consecutive windows begin, and their sizes."""
    i = np.flatnonzero(keep)
    if not len(i):
        return i, i
    new = np.flatnonzero(np.concatenate(([True], first[i[1:]] != first[i[:-1]] + 1)))
    return i[new], np.diff(np.append(new, len(i)))


def covered(n: int, found, length: int) -> np.ndarray:
    """Units of a document of n that lie in any of the (first window, windows)."""
    edge = np.zeros(n + 1, np.int64)
    for s, k in found or ():
        if s < n:
            edge[s] += 1
            edge[min(n, s + k - 1 + length)] -= 1
    return np.cumsum(edge[:-1]) > 0


def per_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``keyed`` rows with their found (start, n) windows as ``found``."""
    got = found.groupBy("d").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    return docs.join(got.hint("merge"), "d", "left")
