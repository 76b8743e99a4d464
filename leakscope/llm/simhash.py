"""SimHash near-duplicates under a generalised pigeonhole.

Every text's fingerprint is the bitwise majority of its shingles' 64-bit
hashes. Texts with equal fingerprints form a class, and classes link at
``max_bits`` or fewer differing bits. The 64 bits are dealt to ``parts``
partitions so that correlated bits fall together. For thresholds t_i (-1: never
probed) with sum(t_i + 1) = max_bits + 1, a pair that differs by more than t_i
in every partition i differs by more than max_bits in all, so probing each
partition within its threshold misses no link. Every fingerprint gets its own
thresholds by dynamic programming on the candidates that a histogram of each
partition's values leads to expect, probes, and candidates are verified.

A partition value shared by many classes is no pair product: its classes are
cut into blocks, and each pair of blocks is one bounded task group that
compares vectors and returns a spanning forest of its links. Components
follow from alternating star contraction on links, checkpointed each round.

Defined cases: null and empty texts have no shingle and fingerprint zero,
linked like any other; a text of fewer words than a shingle is one shingle;
rows that share a doc_id each get the result of their own text; component_id
is null only where all doc_ids of a component are; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import null_safe, written
from leakscope.operators.lineage import materialize

SHINGLE = 3
MAX_BITS = 3
PARTS = 3
SEED = 42
CHUNK = 1 << 18  # shingles hashed at a time
HIST_BITS = 16
CROWD = 48  # classes that share a partition value before it is cut into blocks
BLOCK = 1024


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as a signed integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    a, b = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(a), CHUNK):
        v = np.array([h(flat[x:y], SEED) for x, y in zip(a[i:i + CHUNK], b[i:i + CHUNK])], "<u8")
        ones += np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(a), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row."""
    def run(batches):
        for b in batches:
            fp = [text_fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bits), np.int64)
    for k in range(bits.shape[1]):
        out |= bits[:, k].astype(np.int64) << k
    return out


def partitions(classes: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """Bit numbers of each partition: bits that agree (or disagree) most often
    over all classes are dealt to the same one. The driver sees 65 x 64 sums."""
    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy()).astype(np.float32)
            both += x.T @ x
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([both.ravel().tolist()])], ["n", "v"])
    sums = classes.select("fp").mapInArrow(run, "n long, v array<double>")
    rows = (sums.select("n", F.posexplode("v").alias("i", "x")).groupBy("i")
            .agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect())
    both, n = np.zeros(64 * 64), max([1, *(r["n"] for r in rows)])
    for r in rows:
        both[r["i"]] = r["x"]
    both = both.reshape(64, 64) / n
    mean = np.diag(both)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs((both - np.outer(mean, mean)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(64)), []
    for p in range(parts):
        size = 64 // parts + (p < 64 % parts)
        group = [max(free, key=lambda i: (corr[i, list(free)].sum(), -i))]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda i: (corr[i, group].sum(), -i)))
            free.discard(group[-1])
        out.append(sorted(group))
    return out


def histograms(classes: DataFrame, dealt: list[list[int]]) -> np.ndarray:
    """Classes by the top HIST_BITS bits of each partition's value: a table of
    fixed size, counted over all classes."""
    def run(batches):
        h = np.zeros((len(dealt), 1 << HIST_BITS), np.int64)
        for b in batches:
            x = _bits(b.column(0).to_numpy())
            for p, own in enumerate(dealt):
                h[p] += np.bincount(_pack(x[:, own]) >> max(0, len(own) - HIST_BITS), minlength=1 << HIST_BITS)
        i = np.flatnonzero(h.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(h.ravel()[i])], ["i", "n"])
    got = classes.select("fp").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    h = np.zeros(len(dealt) << HIST_BITS)
    h[got["i"].to_numpy(np.int64)] = got["n"]
    return h.reshape(len(dealt), -1)


def thresholds(values: list[np.ndarray], dealt: list[list[int]], hist: np.ndarray, max_bits: int) -> np.ndarray:
    """One row of thresholds for each fingerprint: least expected candidates
    and probes, by dynamic programming over partitions and what is left of
    max_bits + 1."""
    n, total = len(values[0]), max_bits + 1
    best = np.full((n, total + 1), np.inf)
    best[:, 0] = 0
    pick = np.zeros((len(dealt), n, total + 1), np.int8)
    for p, own in enumerate(dealt):
        w = len(own)
        near = hist[p][values[p] >> max(0, w - HIST_BITS)] / (1 << max(0, w - HIST_BITS))
        away, probes, cost = hist[p].sum() / (1 << w), 0, [np.zeros(n)]
        for t in range(total):
            more = 1
            for k in range(t):
                more = more * (w - k) // (k + 1)
            probes += more
            cost.append(near + away * (probes - 1) + probes)
        new = np.full_like(best, np.inf)
        for used in range(total + 1):
            for c in range(total + 1 - used):
                total_cost = best[:, used] + cost[c]
                better = total_cost < new[:, used + c]
                new[better, used + c] = total_cost[better]
                pick[p, better, used + c] = c
        best = new
    left = np.full(n, total)
    out = np.zeros((n, len(dealt)), np.int64)
    for p in reversed(range(len(dealt))):
        c = pick[p, np.arange(n), left]
        out[:, p] = c.astype(np.int64) - 1
        left -= c
    return out


def probes(classes: DataFrame, dealt: list[list[int]], hist: np.ndarray, max_bits: int) -> DataFrame:
    """(part, value, fp): the partition values that each fingerprint looks up."""
    shared = classes.sparkSession.sparkContext.broadcast(hist)

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            x = _bits(fp)
            values = [_pack(x[:, own]) for own in dealt]
            t = thresholds(values, dealt, shared.value, max_bits)
            for p, own in enumerate(dealt):
                for d in range(max_bits + 1):
                    rows = t[:, p] >= d
                    if not rows.any():
                        continue
                    for flip in combinations(range(len(own)), d):
                        v = values[p][rows] ^ sum(1 << k for k in flip)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(v), p, np.int32)), pa.array(v), pa.array(fp[rows])],
                            ["part", "value", "fp"])
    return classes.select("fp").mapInArrow(run, "part int, value long, fp long")


def index(classes: DataFrame, dealt: list[list[int]]) -> DataFrame:
    """(part, value, fp): each fingerprint under its own partition values."""
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            x = _bits(fp)
            for p, own in enumerate(dealt):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), p, np.int32)), pa.array(_pack(x[:, own])), pa.array(fp)],
                    ["part", "value", "fp"])
    return classes.select("fp").mapInArrow(run, "part int, value long, fp long")


def _forest(a: np.ndarray, b: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks of fingerprints."""
    left = np.setdiff1d(np.union1d(a, b), [])
    seen = np.zeros(len(left), bool)
    in_a, in_b = np.isin(left, a), np.isin(left, b)
    out = []
    for root in range(len(left)):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            i = todo.pop()
            ok = ~seen & (np.bitwise_count(left ^ left[i]) <= max_bits)
            ok &= (in_a[i] & in_b) | (in_b[i] & in_a)
            new = np.flatnonzero(ok)
            seen[new] = True
            out += [(int(left[i]), int(left[j])) for j in new]
            todo += new.tolist()
    return out


def links(classes: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """(a, b): links between different fingerprints; every link where a value
    is not crowded, a spanning forest of them in each pair of blocks else."""
    dealt = partitions(classes, parts)
    hist = histograms(classes, dealt)
    own = written(index(classes, dealt), "simhash-index")
    crowded = own.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    crowded = written(crowded, "simhash-crowded")
    key = ["part", "value"]
    look = probes(classes, dealt, hist, max_bits).withColumnRenamed("fp", "q")
    cold = (look.join(own.join(crowded, key, "left_anti"), key)
            .where((F.col("q") != F.col("fp")) & (F.bit_count(F.expr("q ^ fp")) <= max_bits))
            .select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")))
    # crowded values: blocks of the probing side against blocks of the index side
    asks = (look.join(crowded, key)
            .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("mine", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")))
    asks = asks.select(*key, F.col("q").alias("fp"), F.lit(0).alias("side"), "mine",
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    has = (own.join(crowded, key)
           .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
           .withColumn("other", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    has = has.select(*key, "fp", F.lit(1).alias("side"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine"), "other")

    def block(t: pa.Table) -> pa.Table:
        fp, side = t.column("fp").to_numpy(), t.column("side").to_numpy()
        found = _forest(np.unique(fp[side == 0]), np.unique(fp[side == 1]), max_bits)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    hot = (asks.select("part", "value", "fp", "side", "mine", "other")
           .unionByName(has.select("part", "value", "fp", "side", "mine", "other"))
           .groupBy("part", "value", "mine", "other").applyInArrow(block, "a long, b long"))
    hot = hot.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return cold.unionByName(hot).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): connected components by alternating large-star and
    small-star steps until nothing changes; root is the smallest node."""
    e = materialize(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct())

    def mark(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    last = mark(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b")
                 .where("a != b").distinct())
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        e = materialize(small.select(F.col("m").alias("a"), "b")
                        .unionByName(small.select(F.least("m", "a").alias("a"), F.greatest("m", "a").alias("b")))
                        .where("a != b").distinct())
        now = mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components have not settled")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, fp) of every row, (fp, class_size, low, root) of every class)."""
    fps = written(fingerprints(docs, shingle), "simhash-fp")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("class_size")),
                      "simhash-classes")
    comp = components(links(classes, max_bits, parts))
    named = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    return fps, written(named, "simhash-named")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    parts: int = PARTS) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id (smallest doc_id reachable),
    class_size (rows with this fingerprint)."""
    fps, named = _grouped(docs, shingle, max_bits, parts)
    ids = named.groupBy("root").agg(F.min("low").alias("component_id"))
    per_class = named.join(ids, "root").select("fp", "component_id", "class_size")
    return fps.join(per_class, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "class_size")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                parts: int = PARTS) -> DataFrame:
    """One row of ``docs`` for each component: the one of smallest doc_id (null
    last), then smallest fingerprint. Of equal rows one stays, and of a doc_id
    that names several texts only those that are another's copies go.

    A doc_id whose rows all go, or all of whose rows are one that stays, is
    decided by the doc_id alone; the rows of others are told apart by their
    fingerprints, taken once more."""
    fps, named = _grouped(docs.select("doc_id", "text"), shingle, max_bits, parts)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("fp").alias("f"))
    own = written(fps.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("rows")).join(named.select("fp", "root"), "fp")
                  .withColumn("place", order), "simhash-own")
    first = own.groupBy(F.col("root").alias("_root")).agg(F.min("place").alias("_first"))
    own = written(own.join(first, F.col("root") == F.col("_root"))
                  .select("doc_id", "fp", "rows", (F.col("place") == F.col("_first")).alias("stays")), "simhash-stays")
    per_id = written(own.groupBy("doc_id").agg(F.max("stays").alias("some"), F.sum("rows").alias("rows")), "simhash-ids")
    # written, so that Spark knows how small they are and need not shuffle the texts
    told_apart = written(per_id.where("some AND (rows > 1 OR doc_id IS NULL)").select("doc_id"), "simhash-told-apart")
    apart = written(per_id.where("NOT some OR rows > 1 OR doc_id IS NULL").select("doc_id"), "simhash-gone")
    out = null_safe(docs, apart, "doc_id", "left_anti").select(*docs.columns)
    if told_apart.isEmpty():
        return out
    mixed = written(null_safe(docs, told_apart, "doc_id", "left_semi"), "simhash-mixed")

    @F.arrow_udf("long")
    def fp_of(texts: pa.Array) -> pa.Array:
        return pa.array([text_fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())
    keep = own.where("stays").select(F.col("doc_id").alias("_d"), F.col("fp").alias("_f"))
    again = mixed.withColumn("_fp", fp_of(F.col("text")))
    again = (again.join(keep, again["doc_id"].eqNullSafe(F.col("_d")) & (F.col("_fp") == F.col("_f")), "left_semi")
             .dropDuplicates(["doc_id", "_fp"]))
    return out.unionByName(again.select(*docs.columns))
