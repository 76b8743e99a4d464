"""Hidden Markov language model.

Words are counted over all training documents. The ``EMITTED`` most frequent
words and the end of text have emission probabilities of their own in each
latent state; the others share, in each state, one probability, which their
smoothed corpus frequencies divide, so every word (known or not) has a
probability. Training is Baum-Welch: each pass runs scaled forward and backward
recursions over all training documents where they are read, adds up expected
counts within each task, and sums them over tasks; the bounded model
(``EMITTED`` x ``STATES``) is re-estimated on the driver and broadcast. For
training, a text is cut into sequences of ``LONG`` tokens, which keeps the
recursions of many texts in step; all tokens are counted. Scoring is the scaled
forward recursion, the exact likelihood of the whole text.

Texts are turned into word numbers once: the most frequent words, ``LISTED`` at
most, are broadcast, and words beyond them (a few per cent) are joined to their counts.

Defined cases: null and empty texts consist of the end alone; a null doc_id is
a training row; rows that share a doc_id and text count each and score alike;
with no training rows every word has the one smoothed probability; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import written

STATES = 8
EMITTED = 16_000
LISTED = 200_000
PASSES = 8
SEED = 5
END = "\n"  # no word holds white space
GROUP = 1 << 19  # tokens run through the recursions at once
LONG = 512  # tokens of a training sequence; longer texts count as several


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, n = lists.flatten(), pc.list_value_length(lists).to_numpy()
    text = np.repeat(np.arange(len(texts)), n)
    some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # a text's outer white space leaves empty ones
    return flat.filter(pa.array(some)), np.bincount(text[some], minlength=len(texts))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of the training documents, the ends of text included."""
    def run(batches):
        for b in batches:
            seen = tokens(b.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([seen.field("values"), pa.array([END])]),
                                              pa.concat_arrays([seen.field("counts"), pa.array([b.num_rows], pa.int64())])],
                                             ["word", "c"])
    return (docs.where(~held_out(F.col("doc_id"))).select("text").mapInArrow(run, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def most_frequent(counts: DataFrame, listed: int) -> list[tuple[str, int]]:
    """The end, and the words that occur more often than a limit that leaves at
    most ``listed`` of them, by falling count: the limit comes from the number
    of words of each count, so that no task sorts more than the list."""
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy(F.desc("c"))  # over one row for each distinct count
    over = by_count.withColumn("upto", F.sum("k").over(w)).where(F.col("upto") > listed)
    limit = over.agg(F.max("c")).first()[0] or 0
    top = counts.where((F.col("c") > limit) | (F.col("word") == END)).orderBy(F.desc(F.col("word") == END), F.desc("c"), "word").toArrow()
    return list(zip(top.column("word").to_pylist(), top.column("c").to_pylist()))


class Model:
    """Start, transition and emission probabilities, and corpus frequencies."""

    def __init__(self, listed: list[tuple[str, int]], n: int, v: int, states: int, emitted: int) -> None:
        self.words = [w for w, _ in listed]
        self.n, self.v, self.emitted = n, v, min(emitted, len(listed))
        self.log_base = np.log10((np.array([c for _, c in listed], float) + 1) / (n + v + 1))
        p = 10 ** self.log_base[:self.emitted]
        p = np.append(p, max(1 - p.sum(), 1e-12))  # the rest is one symbol
        self.base = p / p.sum()
        self.log_rest = float(np.log10(self.base[-1]))
        rng = np.random.default_rng(SEED)
        e = self.base[:, None] * np.exp(rng.normal(0, 1, (len(p), states)))
        self.emit = e / e.sum(0)
        self.move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        self.start = np.full(states, 1 / states)

    def parameters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.start, self.move, self.emit

    def learn(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """Expected counts to probabilities; each state's emissions lean on
        the corpus frequencies with the weight of half a token a symbol."""
        s = self.start.shape[0]
        self.start = (start + 1 / s) / (start.sum() + 1)
        self.move = (move + 1 / s) / (move.sum(1, keepdims=True) + 1)
        lean = 0.5 * len(self.base)
        self.emit = (emit + lean * self.base[:, None]) / (emit.sum(0) + lean)


def encode(docs: DataFrame, listed: list[str]) -> DataFrame:
    """(doc_id, held_out, ids, tail): numbers of the listed words, -1 for
    others; tail holds the others. Every text ends with the end."""
    shared = docs.sparkSession.sparkContext.broadcast(listed)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        known = pa.array(shared.value, pa.string())
        for b in batches:
            flat, n = tokens(b.column(2))
            flat = pa.concat_arrays([flat, pa.array([END] * len(n), pa.string())])  # then each end to its place
            place = np.argsort(np.concatenate((np.repeat(np.arange(len(n)), n), np.arange(len(n)))), kind="stable")
            coded = flat.dictionary_encode()
            number = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
            ids = number[coded.indices.to_numpy()[place]].astype(np.int32)
            text = np.repeat(np.arange(len(n)), n + 1)
            others = np.bincount(text[ids < 0], minlength=len(n))
            cuts = [pa.array(np.concatenate(([0], np.cumsum(k))).astype(np.int32)) for k in (n + 1, others)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(cuts[0], pa.array(ids)),
                 pa.ListArray.from_arrays(cuts[1], flat.take(pa.array(place[ids < 0])))], ["doc_id", "held_out", "ids", "tail"])
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, ids array<int>, tail array<string>")


def _groups(ids: pa.ListArray, longest: int = 0):
    """(rows, tokens by step, lengths): sequences of a batch by falling length,
    so those that still run at a step stand first. ``longest`` cuts sequences."""
    flat, off = ids.flatten().to_numpy(), ids.offsets.to_numpy()
    off = off - off[0]
    begin, end, row = off[:-1], off[1:], np.arange(len(ids))
    if longest:
        n = -(-(end - begin) // longest)
        row = np.repeat(row, n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        begin = begin[row] + k * longest
        end = np.minimum(end[row], begin + longest)
    size = end - begin
    order = np.argsort(-size, kind="stable")
    i = 0
    while i < len(order):
        wide = max(1, GROUP // max(1, int(size[order[i]])))
        own = order[i:i + wide]
        i += wide
        n = size[own]
        tokens = np.zeros((int(n[0]), len(own)), np.int32)
        inside = np.arange(len(tokens))[:, None] < n[None, :]
        tokens[inside] = flat[(begin[own][None, :] + np.arange(len(tokens))[:, None])[inside]]
        yield row[own], tokens, n


def _symbols(tokens: np.ndarray, emitted: int) -> np.ndarray:
    return np.where((tokens < 0) | (tokens >= emitted), emitted, tokens)


def forward(tokens: np.ndarray, n: np.ndarray, start, move, emit) -> np.ndarray:
    """log10 likelihood of each column's first n symbols."""
    out = np.zeros(len(n))
    runs = np.searchsorted(-n, -np.arange(len(tokens)), side="left")  # columns with n > step
    a = None
    for t in range(len(tokens)):
        k = runs[t]
        e = emit[tokens[t, :k]]
        a = (start if t == 0 else a[:k] @ move) * e
        z = a.sum(1)
        a /= z[:, None]
        out[:k] += np.log10(z)
    return out


def expected(tokens: np.ndarray, n: np.ndarray, first: np.ndarray, start, move, emit):
    """Expected counts of starts, moves and emissions by scaled forward and
    backward recursions; ``first``: columns that begin a text."""
    steps, states = len(tokens), len(start)
    runs = np.searchsorted(-n, -np.arange(steps), side="left")
    alpha = np.zeros((steps, len(n), states), np.float32)
    scale = np.ones((steps, len(n)), np.float32)
    a = None
    for t in range(steps):
        k = runs[t]
        a = (start if t == 0 else a[:k] @ move) * emit[tokens[t, :k]]
        z = a.sum(1)
        a /= z[:, None]
        alpha[t, :k], scale[t, :k] = a, z
    moves = np.zeros((states, states))
    beta = np.ones((runs[-1], states), np.float32)
    for t in range(steps - 1, -1, -1):
        k = runs[t]
        if t + 1 < steps:
            m = runs[t + 1]
            x = emit[tokens[t + 1, :m]] * beta[:m] / scale[t + 1, :m, None]
            moves += alpha[t, :m].T.astype(np.float64) @ x
            beta = np.ones((k, states), np.float32)
            beta[:m] = x @ move.T
        alpha[t, :k] *= beta
    inside = np.arange(steps)[:, None] < n[None, :]
    gamma, sym = alpha[inside], tokens[inside]
    emits = np.stack([np.bincount(sym, gamma[:, s], minlength=len(emit)) for s in range(states)], 1)
    return alpha[0][first].sum(0, dtype=np.float64), moves * move, emits


def counts_pass(encoded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of one Baum-Welch pass over the training documents."""
    shared = encoded.sparkSession.sparkContext.broadcast((model.parameters(), model.emitted))
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]

    def run(batches):
        (start, move, emit), emitted = shared.value
        start, move, emit = (x.astype(np.float32) for x in (start, move, emit))
        total = np.zeros((1 + states + len(emit), states))
        for b in batches:
            seen = set()
            for rows, tokens, n in _groups(b.column(0), LONG):
                first = np.array([not (r in seen or seen.add(r)) for r in rows.tolist()])
                s, m, e = expected(_symbols(tokens, emitted), n, first, start, move, emit)
                total[0] += s
                total[1:1 + states] += m
                total[1 + states:] += e
        i = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(i), *(pa.array(total[i, s]) for s in range(states))], ["i", *names])
    sums = (encoded.where("NOT held_out").select("ids").mapInArrow(run, "i long, " + ", ".join(f"{x} double" for x in names))
            .groupBy("i").agg(*[F.sum(x).alias(x) for x in names]).toArrow())
    total = np.zeros((1 + states + len(model.base), states))
    total[sums.column("i").to_numpy()] = np.stack([sums.column(x).to_numpy() for x in names], 1) if len(sums) else 0
    return total[0], total[1:1 + states], total[1 + states:]


def score(docs: DataFrame, states: int = STATES, emitted: int = EMITTED, listed: int = LISTED,
          passes: int = PASSES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10)."""
    docs = docs.select("doc_id", "text")
    counts = written(word_counts(docs), "word-counts")
    got = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = got["n"] or 0, got["v"]
    model = Model(most_frequent(counts, listed), n, v, states, emitted)
    rows = encode(docs, model.words).withColumn("row", F.monotonically_increasing_id())
    encoded = written(rows, "word-numbers")
    for _ in range(passes if n else 0):
        model.learn(*counts_pass(encoded, model))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.parameters(), model.emitted, model.log_base, model.log_rest))

    def run(batches):
        (start, move, emit), emitted, log_base, log_rest = shared.value
        for b in batches:
            ids = b.column("ids")
            like, base, rest, known = (np.zeros(b.num_rows) for _ in range(4))
            for own, tokens, size in _groups(ids):
                like[own] = forward(_symbols(tokens, emitted), size, start, move, emit)
            flat = ids.flatten().to_numpy()
            size = np.diff(ids.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), size)
            in_list = flat >= 0
            base += np.bincount(row[in_list], log_base[flat[in_list]], b.num_rows)
            known += np.bincount(row[in_list], minlength=b.num_rows)
            other = in_list & (flat >= emitted)
            rest += np.bincount(row[other], log_base[flat[other]], b.num_rows)
            rest -= log_rest * np.bincount(row[~in_list | other], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("held_out"), pa.array(size.astype(np.int64)),
                 pa.array(known.astype(np.int64)), pa.array(base), pa.array(like + rest)],
                ["row", "doc_id", "held_out", "n_tokens", "n_listed", "base", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = encoded.drop("tail").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_listed long, base double, score double")
    # words beyond the list: their counts, joined
    tail = (encoded.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("k"))
            .join(counts, "word", "left")
            .groupBy("row").agg(F.sum(F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(n + v + 1)))).alias("tail"),
                                F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("tail_known")))
    out = scored.join(tail, "row", "left")
    zero = F.coalesce("tail", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("n_listed") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + zero).alias("base_score"),
                      (F.col("score") + zero).alias("score"))
