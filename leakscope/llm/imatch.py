"""I-Match fingerprints over randomised lexicons.

Document frequencies are counted over the whole corpus, and the lexicon is the
terms whose share of documents lies between ``LOW`` and ``HIGH``: an
inverse-document-frequency band. A document of t distinct terms adds t to
the frequencies, so the band holds at most (mean distinct terms) / LOW terms,
whatever the corpus size; only their 64-bit hashes are broadcast. Each of
``LEXICONS`` subsets holds every term with a fixed chance, from dense subsets
that only equal texts share to sparse ones that like texts share. A
fingerprint is, per subset, a hash of the document's sorted distinct terms in
it (empty: zeros). The likeness of two fingerprints is the share of subsets
with equal hashes among those where either document has a term.

A text without a term in the band is fingerprinted by all its terms.

Defined cases: null and empty texts, and texts without words, have the zero
fingerprint, alike (1) only to another; documents stand in descending
(doc_id, text) order, null doc_ids last; repeated rows follow each other; a
single document is its own next; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.repeats import doc_id, keyed

LOW, HIGH = 0.0005, 0.1
LEXICONS = 96
DENSEST = 4  # subsets hold a term with chance 2**-4 ... 2**-11, twelve of each
LEVELS = 8
WORD = re.compile(r"[^\W_]+")
FLUSH = 400_000  # terms that a task counts before it sends them on
MIX = np.array([xxhash.xxh64_intdigest(bytes([j]), 11) | 1 for j in range(LEXICONS)], np.uint64)
CHANCE = np.array([1 << (64 - DENSEST - j % LEVELS) for j in range(LEXICONS)], np.uint64)


def term_hashes(text: str, memo: dict | None = None) -> np.ndarray:
    """Sorted hashes of the distinct terms."""
    words = set(WORD.findall(text.lower()))
    return np.unique(np.array([xxhash.xxh64_intdigest(w.encode(), 3) for w in words], np.uint64))


def frequencies(rows: DataFrame) -> DataFrame:
    """(term, df) over all documents, counted in each task first."""
    def run(batches):
        seen: dict[str, int] = {}

        def send():
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.array([xxhash.xxh64_intdigest(w.encode(), 3) for w in seen], np.uint64).view(np.int64)),
                 pa.array(list(seen.values()), pa.int64())], ["term", "df"])
            seen.clear()
            return out
        for b in batches:
            for t in b.column(0).to_pylist():
                for w in set(WORD.findall(t.lower())):
                    seen[w] = seen.get(w, 0) + 1
                if len(seen) > FLUSH:
                    yield send()
        yield send()
    return (rows.select("text").mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def lexicon(rows: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    n = rows.count()
    band = frequencies(rows).where(F.col("df").between(max(2.0, low * n), high * n)).select("term")
    return np.sort(band.toArrow().column(0).to_numpy().view(np.uint64))


def fingerprint(text: str, band: np.ndarray) -> np.ndarray:
    """LEXICONS hashes of 16 bits, 0 where the subset has no term."""
    terms = term_hashes(text)
    if len(band) and len(terms):
        at = np.minimum(np.searchsorted(band, terms), len(band) - 1)
        own = terms[band[at] == terms]
        terms = own if len(own) else terms
    out = np.zeros(LEXICONS, np.uint16)
    if not len(terms):
        return out
    with np.errstate(over="ignore"):
        mixed = (terms[None, :] ^ MIX[:, None]) * MIX[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
    inside = mixed < CHANCE[:, None]
    for j in np.flatnonzero(inside.any(1)).tolist():
        h = hashlib.blake2b(terms[inside[j]].tobytes(), digest_size=2).digest()
        out[j] = int.from_bytes(h, "big") or 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    either = (a != 0) | (b != 0)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def _hex(fp: np.ndarray) -> str:
    return fp.astype(">u2").tobytes().hex()


RESULT = ("d long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def report(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = keyed(docs)
    shared = spark.sparkContext.broadcast(lexicon(rows, low, high))
    # stretches of neighbouring doc_ids; the first document of each also goes,
    # as a guest, behind the last one of the stretch before it
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    cuts = sorted(set(rows.select(F.percentile_approx("d", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []))
    @F.arrow_udf("int")
    def part_of(d: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(np.array(cuts, np.int64), d.to_numpy(zero_copy_only=False)), pa.int32())
    placed = rows.withColumn("part", part_of("d"))
    heads = [(r["part"], r["d"]) for r in placed.groupBy("part").agg(F.max("d").alias("d")).orderBy(F.desc("part")).collect()]
    guest_of = {heads[(i + 1) % len(heads)][1]: p for i, (p, _) in enumerate(heads)}

    @F.arrow_udf("int")
    def guest_part(d: pa.Array) -> pa.Array:
        return pa.array([guest_of.get(x) for x in d.to_pylist()], pa.int32())
    to = F.array_compact(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
        F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("part"), F.lit(True).alias("guest")))))
    dealt = (placed.withColumn("also", guest_part("d")).select("d", "text", F.explode(to).alias("to"))
             .select("d", "text", "to.part", "to.guest")
             .repartition("part").sortWithinPartitions("part", "guest", F.desc("d"), F.desc("text")))

    def run(batches):
        band = shared.value
        held = None  # part, d, text, fingerprint of the row that waits for its next
        for b in batches:
            out = []
            for d, text, p, guest in zip(*(b.column(c).to_pylist() for c in ("d", "text", "part", "guest"))):
                fp = fingerprint(text, band)
                if held is not None and held[0] == p:
                    n = len(held[2])
                    edited = held[2][:n - n // 2] + text[:n // 2]
                    efp = fingerprint(edited, band)
                    out.append((held[1], n, hashlib.sha256(edited.encode()).hexdigest(), _hex(held[3]), _hex(efp),
                                likeness(held[3], efp), likeness(held[3], fp)))
                held = None if guest else (p, d, text, fp)
            cols = list(zip(*out)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["d", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    out = dealt.mapInArrow(run, RESULT)
    return out.select(doc_id(F.col("d")).alias("doc_id"), *out.columns[1:])
