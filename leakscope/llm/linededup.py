"""Line deduplication by winnowing over line hashes.

A document is split at newlines and every line hashed. From the hashes of its
``gram``-line grams, each window of ``min_run`` - ``gram`` + 1 consecutive
grams selects its minimum (the rightmost on a tie), so any two equal runs of
``min_run`` lines select the same gram at the same place: selected grams are
guaranteed fingerprints, and a run whose fingerprints occur once is unique.
A line is often a whole paragraph, so a run of fewer lines counts too where it
holds ``min_words`` words: such a window is its own fingerprint.
Fingerprints that occur twice or more are joined to their positions and
extended both ways over the windows that hold them, compared by a 128-bit
digest of the lines themselves; a longer common run holds a fingerprint in each
of its windows, so the extension reaches both its ends. A line goes if it lies
in a window whose lines also start earlier (smaller doc_id, or earlier in the
same document); windows are judged on the input.

DataFrame functions only. Counts and first occurrences are partially
aggregated, and joins meet one row per fingerprint or window, never all pairs.

Defined cases: a null text has no lines and stays null; an empty text is one
empty line; a line has as many words as spaces and one more; rows that
share a doc_id (null sorts first) and text are one document and get the same
result; a row whose doc_id names several texts is judged by the union of its
texts' positions; an empty table gives an empty one; extra columns are kept as
they are and never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import let, null_safe, written

MIN_RUN = 3
MIN_WORDS = 50
GRAM = 2


def line_windows(docs: DataFrame, min_run: int = MIN_RUN, gram: int = GRAM, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, gram, first, s, m, k): the windows beside every selected
    fingerprint (``first`` marks one of them), of m lines from line s, with the digest of their lines. Digests are taken
    within a document's row; the lines themselves are not copied to windows."""
    w = min_run - gram + 1

    def some(x, i, k):  # k elements from place i; ``slice`` would copy the whole array at each call
        return F.array(*[F.get(x, i + j) for j in range(k)])

    def window(r, s, m):
        own = F.array(*[F.when(F.lit(j) < m, F.get(r["lines"], s + j)) for j in range(min_run)])  # a null is not joined
        return F.struct(s.cast("int").alias("s"), m.cast("int").alias("m"), F.unhex(F.md5(F.array_join(own, "\n"))).alias("k"))

    def beside(r, p):  # the windows that hold the gram at -p.n
        first = F.greatest(F.lit(0), -p["n"] - (min_run - gram))
        return F.struct(p["h"].alias("gram"), F.transform(F.sequence(first, F.least(-p["n"], F.size(r["lines"]) - min_run)),
                                                          lambda s: window(r, s, F.lit(min_run))).alias("at"))

    def selected(r):
        n = F.size(r["lines"])
        grams = F.transform(F.sequence(F.lit(0), F.greatest(n - gram, F.lit(0))), lambda i: F.struct(
            F.xxhash64(some(r["h"], i, gram)).alias("h"), (-i).alias("n")))
        every = let(grams, lambda g: F.transform(F.sequence(F.lit(1), F.greatest(F.size(g) - (w - 1), F.lit(1))),
                                                 lambda i: F.array_min(some(g, i - 1, w))))
        # places never fall, so equal selections are neighbours
        least = let(every, lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1)["n"] != x["n"])))
        return F.when(n >= min_run, F.transform(least, lambda p: beside(r, p))).otherwise(F.array())

    def heavy(r, i):  # the fewest lines from line i, below min_run, that hold min_words
        m = F.lit(None).cast("int")
        for k in range(min_run - 1, 0, -1):
            held = sum((F.get(r["words"], i + j) for j in range(1, k)), F.get(r["words"], i))
            m = F.when((i + k <= F.size(r["lines"])) & (held >= min_words), k).otherwise(m)
        return F.struct(i.alias("i"), m.alias("m"))

    def alone(r):
        short = F.filter(F.transform(F.sequence(F.lit(0), F.size(r["lines"]) - 1), lambda i: heavy(r, i)),
                         lambda x: x["m"].isNotNull())
        return F.transform(short, lambda x: F.struct(F.xxhash64(x["m"], window(r, x["i"], x["m"])["k"]).alias("gram"),
                                                     F.array(window(r, x["i"], x["m"])).alias("at")))

    def hashed(lines):
        return F.struct(lines.alias("lines"), F.transform(lines, lambda x: F.xxhash64(x)).alias("h"), F.transform(
            lines, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"))
    entries = let(F.split("text", "\n", -1), lambda lines: let(hashed(lines), lambda r: F.concat(selected(r), alone(r))))
    return (docs.where(F.col("text").isNotNull()).select("doc_id", F.explode(entries).alias("e"))
            .select("doc_id", "e.gram", F.posexplode("e.at").alias("at", "w"))
            .select("doc_id", "gram", (F.col("at") == 0).alias("first"), "w.s", "w.m", "w.k"))


def repeated_lines(docs: DataFrame, min_run: int = MIN_RUN, gram: int = GRAM, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, gone): per document with repeated runs, the 0-based numbers of
    the lines to delete, ascending."""
    prints = written(line_windows(docs, min_run, gram, min_words), "line-prints")
    twice = prints.groupBy("gram").agg(F.count_if("first").alias("n")).where("n > 1").select("gram")
    windows = (prints.join(twice, "gram", "left_semi")
               .select("doc_id", "s", "m", "k").distinct())
    windows = written(windows, "line-windows")
    first = (windows.groupBy("k").agg(F.min(F.struct("doc_id", "s")).alias("first"),
                                      F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = (windows.join(first, "k")
             .where(~F.struct("doc_id", "s").eqNullSafe(F.col("first"))))
    gone = (later.select("doc_id", F.explode(F.sequence("s", F.col("s") + F.col("m") - 1)).alias("i"))
            .distinct())
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_list("i")).alias("gone"))


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, gram: int = GRAM, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``_lines`` (all), ``_kept`` (left) and ``_gone`` (numbers)."""
    gone = repeated_lines(docs, min_run, gram, min_words).withColumnRenamed("gone", "_gone")
    # one plan at all sizes: the deleted lines grow with the corpus
    out = null_safe(docs, gone.hint("merge"), "doc_id", "left").withColumn("_lines", F.split("text", "\n", -1))
    # a doc_id's other texts may be longer than this one
    out = out.withColumn("_gone", let(F.size("_lines"), lambda n: F.filter("_gone", lambda i: i < n)))

    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = let(F.col("_lines"), lambda lines: F.transform(left, lambda i: F.get(lines, i)))
    return out.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept))


def without_repeats(docs: DataFrame, min_run: int = MIN_RUN, gram: int = GRAM, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later repeated runs deleted from ``text`` (lines joined
    by newlines again) and ``n_chars``, if there, recounted for changed texts."""
    cols = docs.columns
    out = dedup_lines(docs, min_run, gram, min_words)
    changed = F.col("_gone").isNotNull()
    text = F.when(changed, F.array_join("_kept", "\n")).otherwise(F.col("text"))
    out = out.withColumn("_text", text)
    new = {"text": F.col("_text")}
    if "n_chars" in cols:
        new["n_chars"] = F.when(changed, F.length("_text").cast(docs.schema["n_chars"].dataType)
                                ).otherwise(F.col("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in cols])


def report(docs: DataFrame, min_run: int = MIN_RUN, gram: int = GRAM, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_runs, kept_sha256."""
    out = dedup_lines(docs.select("doc_id", "text"), min_run, gram, min_words)
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    runs = let(gone, lambda g: F.size(F.filter(g, lambda x, i: (i == 0) | (F.element_at(g, F.greatest(i, F.lit(1))) != x - 1))))
    return out.select(
        "doc_id", F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"), runs.cast("long").alias("n_runs"),
        F.sha2(F.coalesce(F.array_join("_kept", "\n"), F.lit("")), 256).alias("kept_sha256"))
