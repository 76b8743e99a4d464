"""Toxicity from the nearest labelled examples.

A bounded, documented sample of labelled rows (``max_examples`` of each class,
those of smallest hash, and of these the first that hold ``MAX_TEXT_BYTES`` of
text together) is the example set. Its words are the lexicon; document
frequencies of the lexicon are counted over the whole corpus. Texts are unit
TF-IDF vectors over the lexicon, and the k nearest examples by cosine are exact.
They are the evidence. Votes weigh by distance, and the label rate has a weight
among them, so a few distant neighbours decide nothing. Among all words of a
long text the few that make it toxic weigh little, so the k nearest over the
terms (words, and the first four and five letters of words) whose presence goes
with the label beyond chance vote beside the k nearest over all words. An
isotonic curve, fitted on the examples' own leave-one-out votes weighted to the
label rates of all labelled rows, makes the votes scores.

**Block-max index.** Examples that are alike stand together in blocks. The
postings of rare terms are met in full. Those of the ``DENSE`` most frequent
terms are kept block by block with each block's largest weight of every term; the
maxima bound what a block's rows can still gain. The blocks of greatest bound are
met first, and then only blocks whose bound reaches the k-th best sum so far;
the others are skipped. Sums in single precision choose the rows that can be
among the k, which are then compared by cosines in double precision.

The index (vectors of a sample of bounded size) is the only thing that reaches
the driver and is broadcast; texts are scored, and the examples' own votes
taken, in the tasks.

Defined cases: null and empty texts, and texts without a word of any example,
have no neighbour and get the rate of such examples; rows with a null label or
doc_id are no examples; of several labels of one doc_id the largest counts;
repeated rows get equal scores; without examples every score is 0; ties of
cosine go to the example that stands first; only doc_id, text and toxic are
read, whatever other columns there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from leakscope.llm.common import written

MAX_EXAMPLES = 2000
MAX_TEXT_BYTES = 64_000_000  # of all examples' texts: what the driver and the broadcast can hold
NEIGHBOURS = 15
PRIOR = 60.0  # weight of the label rate among the votes: distant neighbours say little
MIN_G = 16.0  # log-likelihood ratio, about one in 16,000 by chance
DENSE = 512   # terms with the longest postings, kept by block
BLOCK = 64    # examples of one block
FIRST = 6     # blocks of greatest bound that are met before any is skipped
SLACK = 1e-4  # far above the error of a sum in single precision
BATCH = 128
PIECE = 4_000_000  # letters of the texts that are looked up at a time
WORD = re.compile(r"[^\W\d_]+")
LETTERS = bytes(c if chr(c).isalpha() and c < 128 else 32 for c in range(256))  # the same for ASCII


def spaced(text: str | None) -> str:
    """The words of a text in lower case, with spaces between."""
    t = (text or "").lower()
    return t.encode().translate(LETTERS).decode() if t.isascii() else " ".join(WORD.findall(t))


def words(text: str | None) -> list[str]:
    return spaced(text).split()


def beginnings(word: str) -> tuple[str, ...]:
    return ("^" + word[:4], "^" + word[:5]) if len(word) > 4 else ("^" + word[:4],)


def examples(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, toxic, text): the bounded sample of labelled rows."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    pick = None
    for y in (0, 1):  # at most max_examples rows each, found by a partial top-k
        p = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
        pick = p if pick is None else pick.unionByName(p)
    found = (docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))
    # a running sum over at most 2 max_examples rows
    so_far = F.sum(F.octet_length(F.coalesce("text", F.lit("")))).over(
        Window.partitionBy(F.lit(1)).orderBy(F.xxhash64("doc_id"), "doc_id"))
    return found.withColumn("_bytes", so_far).where(F.col("_bytes") <= MAX_TEXT_BYTES).drop("_bytes")


def term_counts(sample: DataFrame) -> tuple[list[str], np.ndarray, list[int]]:
    """All words and beginnings of the examples, the examples of class 0 and 1
    that hold each, and the examples of each class."""
    def run(batches):
        held: tuple[Counter, Counter] = (Counter(), Counter())
        n = [0, 0]
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = set(words(t))
                held[y].update(own | set(chain.from_iterable(map(beginnings, own))))
                n[y] += 1
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(["", *held[y]]), pa.array([y] * (len(held[y]) + 1), pa.int32()),
                                              pa.array([n[y], *held[y].values()], pa.int64())], ["term", "y", "n"])
    got = (sample.select("text", "toxic").mapInArrow(run, "term string, y int, n long").groupBy("term")
           .agg(*[F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)])
           .orderBy("term").toArrow())
    term, held = got["term"].to_pylist(), np.stack([got["n0"].to_numpy(), got["n1"].to_numpy()]) if len(got) else np.zeros((2, 1), int)
    return term[1:], held[:, 1:], held[:, 0].tolist()  # the empty term counts examples


def telling(held: np.ndarray, n: list[int]) -> np.ndarray:
    """Whether a term's presence goes with the label beyond chance, by its
    log-likelihood ratio."""
    g, some, total = np.zeros(held.shape[1]), held[0] + held[1], max(1, sum(n))
    for y in (0, 1):
        for x, e in ((held[y], some * (n[y] / total)), (n[y] - held[y], (total - some) * (n[y] / total))):
            g += np.where(x > 0, x * np.log(np.maximum(x, 1) / np.where(e > 0, e, 1)), 0)
    return 2 * g >= MIN_G


def _find(u: pa.Array, among: pa.Array) -> np.ndarray:
    """The place of each string in ``among``, or -1."""
    if not len(among):
        return np.full(len(u), -1, np.int64)
    return pc.fill_null(pc.index_in(u, value_set=among), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Lexicon:
    """Numbers of words, and of telling terms, for many texts at a time."""

    def __init__(self, known: list[str], tells: list[str]) -> None:
        self.known = pa.array(known, pa.string())
        kinds = [[t for t in tells if t[0] != "^"], [t[1:] for t in tells if t[0] == "^" and len(t) <= 5],
                 [t[1:] for t in tells if t[0] == "^" and len(t) > 5]]
        at = {t: i for i, t in enumerate(tells)}
        self.terms = [pa.array(k, pa.string()) for k in kinds]  # whole words, beginnings of four and of five letters
        self.numbers = [np.array([at[p + t] for t in k], np.int64) for k, p in zip(kinds, ("", "^", "^"))]
        self.n_tells = len(tells)

    def held(self, texts: list[str | None]):
        """(first text, texts, (text, word, count), (text, telling term,
        count)) of pieces of some ``PIECE`` letters; each sorted and without
        repeats, texts numbered within the piece."""
        low = 0
        while low < len(texts):
            piece, size = [], 0
            while low + len(piece) < len(texts) and (size < PIECE or not piece):
                piece.append(spaced(texts[low + len(piece)]))
                size += len(piece[-1])
            yield (low, len(piece), *self._held(pa.array(piece, pa.string())))
            low += len(piece)

    def _held(self, piece: pa.Array) -> tuple[tuple, tuple]:
        lists = pc.ascii_split_whitespace(piece)
        text = np.repeat(np.arange(len(piece)), pc.list_value_length(lists).to_numpy())
        coded = lists.flatten().dictionary_encode()
        u = coded.dictionary
        word = _find(u, self.known)
        by_word = np.argsort(word, kind="stable")  # so that pairs come sorted by word
        rank = np.empty(len(u), np.int64)
        rank[by_word] = np.arange(len(u))
        pairs = np.sort(text * max(1, len(u)) + rank[coded.indices.to_numpy()])
        new = np.flatnonzero(np.diff(pairs, prepend=-1))
        count = np.diff(np.append(new, len(pairs)))
        text, own = pairs[new] // max(1, len(u)), by_word[pairs[new] % max(1, len(u))]
        at = word[own]
        longer = pc.greater(pc.utf8_length(u), 4).to_numpy(zero_copy_only=False).astype(bool)
        strings = (u, pc.utf8_slice_codeunits(u, 0, 4), pc.utf8_slice_codeunits(u, 0, 5))
        found = []
        for k, (x, among, numbers) in enumerate(zip(strings, self.terms, self.numbers)):
            f = _find(x, among)
            f[f >= 0] = numbers[f[f >= 0]]
            if k == 2:
                f[~longer] = -1
            t = f[own]
            found.append((text[t >= 0] * max(1, self.n_tells) + t[t >= 0], count[t >= 0]))
        key, c = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(key, kind="stable")
        key, c = key[order], c[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        c = np.add.reduceat(c, new) if len(new) else c
        return (text[at >= 0], at[at >= 0], count[at >= 0]), (key[new] // max(1, self.n_tells), key[new] % max(1, self.n_tells), c)

    def __call__(self, texts: list[str | None]):
        """Numbers and counts of each text's lexicon words, and telling terms."""
        for _, n, *both in self.held(texts):
            edges = [np.searchsorted(text, np.arange(n + 1)) for text, _, _ in both]
            for r in range(n):
                yield tuple(x[e[r]:e[r + 1]] for (_, i, c), e in zip(both, edges) for x in (i, c))


def _parts(texts: pa.Array):
    """Stretches of the texts, so that a worker holds the Python strings of
    these only."""
    return (texts.slice(n, 16 * BATCH).to_pylist() for n in range(0, len(texts), 16 * BATCH))


def _lexicon(shared) -> Lexicon:
    """Made once in each worker process on its own copy of the broadcast."""
    made = getattr(shared, "made", None)
    if made is None:
        made = shared.made = Lexicon(*shared.value)
    return made


def document_frequencies(docs: DataFrame, shared, size: int, n_tells: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Documents, and those that hold each lexicon word and each telling term,
    over the whole corpus."""
    def run(batches):
        lex = _lexicon(shared)
        df = np.zeros(size + n_tells + 1, np.int64)
        for b in batches:
            for texts in _parts(b.column(0)):
                for _, n, (_, word, _), (_, told, _) in lex.held(texts):
                    df[:size] += np.bincount(word, minlength=size)
                    df[size:-1] += np.bincount(told, minlength=n_tells)
                    df[-1] += n
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["i", "n"])
    got = docs.select("text").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + n_tells + 1, np.int64)
    df[got["i"].to_numpy()] = got["n"].to_numpy()
    return int(df[-1]), df[:size], df[size:-1]


def _unit(v: np.ndarray) -> np.ndarray:
    return v / (math.sqrt((v * v).sum()) or 1.0)


def _stretches(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first[j] to first[j] + n[j] - 1 of all j, one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(first - (ends - n), n)


def _alike_together(vectors: list[tuple], size: int, block: int) -> np.ndarray:
    """An order of the rows in which alike ones stand together: halves along
    the direction of greatest spread of 16 random projections, again and again."""
    n = len(vectors)
    drawn = np.random.default_rng(0).standard_normal((size, 16)).astype(np.float32)
    x = np.zeros((n, 16), np.float32)
    for r, (i, v) in enumerate(vectors):
        x[r] = v @ drawn[i]
    todo, out = [np.arange(n)], []
    while todo:
        rows = todo.pop()
        if len(rows) <= block:
            out.append(rows)
            continue
        y = x[rows] - x[rows].mean(0)
        rows = rows[np.argsort(y @ np.linalg.eigh(y.T @ y)[1][:, -1], kind="stable")]
        half = (len(rows) // 2 + block - 1) // block * block
        todo += [rows[half:], rows[:half]]
    return np.concatenate([np.zeros(0, np.int64), *out])


class Postings:
    """Unit vectors by row and as postings by term: rare terms' in full, the
    ``dense`` most frequent ones' by block of rows with the block's maxima."""

    def __init__(self, vectors: list[tuple], size: int, dense: int = DENSE, block: int = BLOCK) -> None:
        n = self.n = len(vectors)
        self.number = _alike_together(vectors, size, block)  # of the row at each place
        self.place = np.argsort(self.number)
        vectors = [vectors[r] for r in self.number.tolist()]
        self.starts = np.cumsum([0, *(len(i) for i, _ in vectors)])
        self.term = np.concatenate([np.zeros(0, np.int64), *(i for i, _ in vectors)]).astype(np.int32)
        self.weight = np.concatenate([np.zeros(0), *(v for _, v in vectors)])
        order = np.argsort(self.term, kind="stable")
        self.held = np.bincount(self.term, minlength=size)
        self.first = np.cumsum(self.held) - self.held
        self.at = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.starts))[order]
        self.posted = self.weight[order].astype(np.float32)
        often = np.argsort(-self.held, kind="stable")[:min(dense, np.count_nonzero(self.held > block))]
        self.line = np.full(size, -1, np.int32)
        self.line[often] = np.arange(len(often))
        lines = np.zeros((len(often), n), np.float32)
        line = self.line[self.term[order]]
        lines[line[line >= 0], self.at[line >= 0]] = self.posted[line >= 0]
        self.edges = np.arange(0, n, block)
        self.blocks = [np.ascontiguousarray(lines[:, e:e + block]) for e in self.edges.tolist()]
        self.top = np.stack([b.max(1, initial=0) for b in self.blocks], 1) if self.blocks else np.zeros((0, 0))
        self.skipped = self.met = 0

    def nearest(self, vectors: list[tuple], k: int, skips: list[int] | None = None) -> list[tuple]:
        """Numbers and cosines of each vector's k nearest rows, best first."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(vectors)
        heavy = np.zeros((len(vectors), len(self.top)), np.float32)
        s = np.zeros((len(vectors), self.n), np.float32)
        for q, (i, v) in enumerate(vectors):
            line = self.line[i]
            often = line >= 0
            heavy[q, line[often]] = v[often]
            rare, w = i[~often], v[~often].astype(np.float32)
            held = self.held[rare]
            p = _stretches(self.first[rare], held)
            s[q] = np.bincount(self.at[p], self.posted[p] * np.repeat(w, held), self.n)
        bound = heavy @ self.top
        bound += np.maximum.reduceat(s, self.edges, axis=1)
        met = np.zeros(bound.shape, bool)
        if bound.shape[1] > FIRST:
            np.put_along_axis(met, np.argpartition(-bound, FIRST, axis=1)[:, :FIRST], True, axis=1)
        else:
            met[:] = True
        self._meet(s, heavy, met)
        # rows not met yet count with less than they have: a smaller, safe limit
        more = ~met & (bound >= self._least(s, k, skips)[:, None] - SLACK) & (bound > 0)
        self._meet(s, heavy, more)
        self.met += int(met.sum() + more.sum())
        self.skipped += int(met.size - met.sum() - more.sum())
        least = self._least(s, k, skips)
        out, whole = [], np.zeros(len(self.held))
        for q, (i, v) in enumerate(vectors):
            if skips and skips[q] >= 0:
                s[q, self.place[skips[q]]] = 0
            found = np.flatnonzero((s[q] > 0) & (s[q] >= least[q] - SLACK))
            whole[i] = v
            n = self.starts[found + 1] - self.starts[found]
            p = _stretches(self.starts[found], n)
            cos = np.add.reduceat(whole[self.term[p]] * self.weight[p], np.cumsum(n) - n) if len(found) else np.zeros(0)
            whole[i] = 0
            found = self.number[found]
            best = np.lexsort((found, -cos))[:k]
            out.append((found[best], cos[best]))
        return out

    def _meet(self, s: np.ndarray, heavy: np.ndarray, which: np.ndarray) -> None:
        for b, e in enumerate(self.edges.tolist()):
            q = np.flatnonzero(which[:, b])
            if len(q):
                s[q, e:e + self.blocks[b].shape[1]] += heavy[q] @ self.blocks[b]

    def _least(self, s: np.ndarray, k: int, skips: list[int] | None) -> np.ndarray:
        """The k-th best sum of each vector (one further down where a row of
        its own is to be skipped)."""
        k += bool(skips)
        return np.partition(s, -k, axis=1)[:, -k] if k < self.n else np.zeros(len(s), np.float32)


class Index:
    """The examples' vectors over all words, and over the terms that tell the
    label. A text may also come as its numbers and counts."""

    def __init__(self, known: list[str], idf: np.ndarray, rows: list[tuple], tells: list[str] = (),
                 tell_idf: np.ndarray | None = None, numbers: Lexicon | None = None) -> None:
        self.numbers = numbers or Lexicon(known, tells)
        self.idf, self.tell_idf = idf, np.zeros(0) if tell_idf is None else tell_idf
        both = self.vectors([t for _, _, t in rows])
        made = sorted(((i, y, *v) for (i, y, _), v in zip(rows, both) if len(v[0][0])), key=lambda m: m[0])
        self.ids = np.array([m[0] for m in made], np.int64)
        self.labels = np.array([m[1] for m in made], np.float64)
        self.all = Postings([m[2] for m in made], len(idf))
        self.telling = Postings([m[3] for m in made], len(self.tell_idf))
        self.rate, self.unknown = 0.0, 0.0
        self.curve = (np.array([0.0]), np.array([0.0]))

    def vectors(self, texts: list) -> list[tuple[tuple, tuple]]:
        """Unit vectors over the lexicon and over the telling terms."""
        held = texts if texts and isinstance(texts[0], tuple) else self.numbers(texts)
        return [((i, _unit((1 + np.log(n)) * self.idf[i])), (ti, _unit((1 + np.log(tn)) * self.tell_idf[ti])))
                for i, n, ti, tn in held]

    def votes(self, texts: list, k: int, skips: list[int] | None = None) -> list[tuple]:
        """Vote, k nearest examples and their cosines of each text. Those
        nearest by the terms that tell the label vote too."""
        out, both = [], self.vectors(texts)
        for n in range(0, len(both), BATCH):
            skip = skips[n:n + BATCH] if skips else None
            near = self.all.nearest([v for v, _ in both[n:n + BATCH]], k, skip)
            told = self.telling.nearest([v for _, v in both[n:n + BATCH]], k, skip)
            out += [(self.vote(np.concatenate((f, tf)), np.concatenate((c, tc))), f, c)
                    for (f, c), (tf, tc) in zip(near, told)]
        return out

    def vote(self, found: np.ndarray, cos: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(cos, 1).astype(np.float64)) ** 2
        return float(((w * self.labels[found]).sum() + PRIOR * self.rate) / (w.sum() + PRIOR))

    def own_votes(self, rows: list[tuple], k: int) -> list[tuple]:
        """(label, vote or None) of examples, each without itself."""
        place = {int(d): n for n, d in enumerate(self.ids)}
        got = self.votes([t for _, _, t in rows], k, [place.get(d, -1) for d, _, _ in rows])
        return [(y, vote if len(found) else None) for (_, y, _), (vote, found, _) in zip(rows, got)]

    def scores(self, texts: list[str | None], k: int) -> list[tuple[float, list[int], list[float]]]:
        out = []
        x, y = self.curve
        for vote, found, cos in self.votes(texts, k):
            s = float(y[min(len(y) - 1, int(np.searchsorted(x, vote)))]) if len(found) else self.unknown
            out.append((s, self.ids[found].tolist(), [round(c, 6) for c in cos.tolist()]))
        return out


def isotonic(own: list[tuple], rate: float) -> tuple[tuple, float]:
    """((votes, scores), score of texts without a neighbour): a curve that
    rises with the vote, fitted to (label, vote) weighted to ``rate``."""
    share = sum(y for y, _ in own) / max(1, len(own))
    weight = {1: rate / share if share else 0.0, 0: (1 - rate) / (1 - share) if share < 1 else 0.0}
    none = [(y, weight[y]) for y, vote in own if vote is None]
    w0 = sum(w for _, w in none)
    pools: list[list[float]] = []  # weight, weighted labels, highest vote
    for x, y in sorted((vote, y) for y, vote in own if vote is not None):
        pools.append([weight[y], y * weight[y], x])
        while len(pools) > 1 and (pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]
                                  or pools[-2][2] == pools[-1][2]):
            w2, y2, x2 = pools.pop()
            pools[-1] = [pools[-1][0] + w2, pools[-1][1] + y2, x2]
    curve = (np.array([p[2] for p in pools]), np.array([p[1] / (p[0] or 1) for p in pools])) if pools else (
        np.array([0.0]), np.array([0.0]))
    return curve, sum(y * w for y, w in none) / w0 if w0 else 0.0


def _index(shared) -> Index:
    """Built once in each worker process from its copy of the broadcast."""
    made = getattr(shared, "made", None)
    if made is None:
        known, tells, idf, tell_idf, ids, labels, rate, numbers, curve, unknown = shared.value
        ends = [np.cumsum([0, *n]) for n in numbers[4:]]
        rows = []
        for r, (d, y) in enumerate(zip(ids, labels)):
            a, b, c, e = ends[0][r], ends[0][r + 1], ends[1][r], ends[1][r + 1]
            rows.append((d, y, (numbers[0][a:b].astype(np.int64), numbers[1][a:b], numbers[2][c:e].astype(np.int64), numbers[3][c:e])))
        made = shared.made = Index(known, idf, rows, tells, tell_idf)
        made.rate, made.curve, made.unknown = rate, curve, unknown
    return made


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, k: int = NEIGHBOURS):
    """The broadcast index: plain arrays of the bounded sample."""
    spread = docs.sparkSession.sparkContext.broadcast
    sample = written(examples(docs, labels, max_examples), "toxic-examples")
    term, held, n = term_counts(sample)
    tells_label = telling(held, n)
    known = [t for t in term if t[0] != "^"]
    tells = [t for t, x in zip(term, tells_label.tolist()) if x]
    lexicon = spread((known, tells))
    total, df, tell_df = document_frequencies(docs, lexicon, len(known), len(tells)) if known else (0, np.zeros(0), np.zeros(0))
    idf, tell_idf = (np.log((1 + total) / (1 + x)) + 1 for x in (df, tell_df))

    def run(batches):  # only numbers leave a task, never whole texts
        lex = _lexicon(lexicon)
        for b in batches:
            rows = list(lex(b.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array([r[c].astype(np.int32).tobytes() for r in rows], pa.binary()) for c in range(4))],
                ["doc_id", "toxic", "i", "n", "ti", "tn"])
    got = sample.select("doc_id", "toxic", "text").mapInArrow(
        run, "doc_id long, toxic int, i binary, n binary, ti binary, tn binary").orderBy("doc_id").collect()
    flat = [np.frombuffer(b"".join(r[c] for r in got), np.int32) for c in ("i", "n", "ti", "tn")]
    flat += [[len(r[c]) // 4 for r in got] for c in ("i", "ti")]
    rate = labels.select(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    parts = (known, tells, idf, tell_idf, [r["doc_id"] for r in got], [r["toxic"] for r in got], rate, flat)
    uncalibrated = spread((*parts, None, 0.0))

    def own(batches):
        index = _index(uncalibrated)
        for b in batches:
            found = index.own_votes(list(zip(*(b.column(c).to_pylist() for c in range(3)))), k)
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in found], pa.int32()),
                                              pa.array([v for _, v in found], pa.float64())], ["y", "vote"])
    parted = sample.select("doc_id", "toxic", "text").repartition(max(1, min(64, len(got) // BATCH)))
    votes = [(r["y"], r["vote"]) for r in parted.mapInArrow(own, "y int, vote double").collect()] if known else []
    return spread((*parts, *isotonic(votes, rate)))


RESULT = StructType([StructField("score", DoubleType()), StructField("neighbours", ArrayType(LongType())),
                     StructField("cosines", ArrayType(DoubleType()))])


def scorer(shared, k: int = NEIGHBOURS):
    """A column function text -> struct(score, neighbours, cosines)."""
    @F.arrow_udf(RESULT)
    def score(texts: pa.Array) -> pa.Array:
        got = [g for part in _parts(texts) for g in _index(shared).scores(part, k)]
        return pa.StructArray.from_arrays(
            [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.list_(pa.int64())),
             pa.array([g[2] for g in got], pa.list_(pa.float64()))], ["score", "neighbours", "cosines"])
    return score


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, neighbours, cosines."""
    index = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    s = docs.select("doc_id", scorer(index)(F.col("text")).alias("s"))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("s.score").alias("score"),
                    (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.neighbours", "s.cosines")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts of score 0.5 or more."""
    index = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    cols = docs.columns
    return (docs.withColumn("_toxic", scorer(index)(F.col("text"))["score"])
            .where("_toxic < 0.5").select(*[F.col(f"`{c}`") for c in cols]))
