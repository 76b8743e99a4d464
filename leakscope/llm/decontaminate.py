"""Benchmark decontamination with a distributed positional inverted index.

Document frequencies of the benchmark's terms are counted over the corpus. In
every benchmark window the rarest term is the anchor; only anchor terms get
postings (term, document, position, neighbouring words), which are stored.
An anchor's posting list is joined to its benchmark places (the offset-adjusted
intersection): the words left and right of the posting are compared with the
words left and right of the anchor, so a run of equal words around it is
an exact phrase occurrence. Every occurring window holds its own anchor, so no
occurrence is lost. ``proximity_matches`` answers from the same postings which
windows have enough of their words near an anchor in any order.

Everything is DataFrame functions. The benchmark side is written first, so
Spark broadcasts it only under its own size check and shuffles otherwise; index
terms are broadcast up to a counted limit, with another way beyond it.

Defined cases: null and empty texts have no words and are clean; rows that
share a doc_id (null included) are one document: its hits are the union over
its rows and each row reports them; items with null or empty text never
occur; an empty table gives an empty result, an empty benchmark no hits;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import ascii_lower, null_safe, written

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 13
FEW_TERMS = 200_000  # some megabytes at most


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def anchors(items: DataFrame, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(term, item_id, left, right, need): for each window of each item the
    place of its rarest term, with up to ``window`` - 1 item words on either
    side (left ones nearest first). Terms absent from the corpus have no
    postings, and a window that holds one cannot occur."""
    it = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    it = written(it.dropDuplicates(), "bench-items")
    places = it.select("item_id", "w", F.posexplode("w").alias("q", "term"))
    vocab = written(places.select("term").distinct(), "bench-terms")
    df = (docs.select(F.explode(words(F.col("text"))).alias("term"))
          .join(vocab, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    df = written(vocab.join(df, "term", "left").fillna(0, ["df"]), "bench-df")
    need = F.least(F.size("w"), F.lit(window))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("q") - F.col("need") + 1),
                                  F.least(F.col("q"), F.size("w") - F.col("need"))))
    rarest = (places.join(df, "term").withColumn("need", need)
              .select("item_id", "w", "q", "term", "df", "need", starts.alias("s"))
              .groupBy("item_id", "w", "s", "need").agg(F.min(F.struct("df", "term", "q")).alias("a"))
              .where("a.df > 0").select("item_id", "w", "need", "a.term", "a.q").distinct())
    return written(rarest.select("term", "item_id", "need", *around("w", F.col("q"), window)),
                   "bench-anchors")


def around(w: str, q: Column, window: int) -> list[Column]:
    """Words before (nearest first) and after place ``q`` (0-based) of array ``w``."""
    k = window - 1
    first = F.greatest(F.lit(1), q - k + 1)
    return [F.reverse(F.slice(w, first, q - first + 1)).alias("before"),
            F.slice(w, q + 2, F.lit(k)).alias("after")]


def postings(docs: DataFrame, terms: DataFrame, window: int = WINDOW,
             few_terms: int = FEW_TERMS) -> DataFrame:
    """(doc_id, n_words, first, term, pos, before, after), stored: the postings
    of the index terms, and beside them (``first``, maybe without a term) one
    row for every row of ``docs``, so that one pass over the texts also counts
    their words. Up to ``few_terms`` terms (counted) are broadcast and a
    document's words never move. Beyond, the narrow (term, doc_id, pos) rows are
    joined to the terms, and what is found goes back to its documents for the
    neighbouring words."""
    own = terms.select(F.col("term").alias("_term")).distinct()
    texts = docs.select("doc_id", words(F.col("text")).alias("w"))
    first = (F.coalesce("pos", F.lit(0)) == 0).alias("first")
    place = F.posexplode_outer("w").alias("pos", "word")
    if own.count() <= few_terms:
        p = (texts.select("doc_id", "w", place).join(F.broadcast(own), F.col("word") == F.col("_term"), "left")
             .select("*", first).where(F.col("_term").isNotNull() | F.col("first")))
    else:
        found = (texts.select("doc_id", F.posexplode("w").alias("pos", "_term")).join(own, "_term", "left_semi")
                 .groupBy("doc_id").agg(F.collect_set(F.struct("pos", "_term")).alias("found")))
        place = F.explode(F.concat(F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("_term"))),
                                   F.coalesce("found", F.array()))).alias("f")
        p = (null_safe(texts, found, "doc_id", "left").select("doc_id", "w", place).select("doc_id", "w", "f.*")
             .select("*", F.col("pos").isNull().alias("first"))
             .where(F.col("first") | (F.get("w", F.col("pos")) == F.col("_term"))))
    near = [F.when(F.col("_term").isNotNull(), c).alias(n) for c, n in zip(around("w", F.col("pos"), window), ("before", "after"))]
    return written(p.select("doc_id", F.size("w").cast("long").alias("n_words"), "first", F.col("_term").alias("term"),
                            F.when(F.col("_term").isNotNull(), F.col("pos")).alias("pos"), *near), "postings")


def run(a: Column, b: Column) -> Column:
    """Length of the common prefix of two word arrays."""
    diff = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(diff > 0, diff - 1).otherwise(F.size(a)).cast("int")


def phrase_matches(post: DataFrame, anch: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end): runs of document words equal to
    consecutive item words that hold at least one whole window."""
    b = anch.withColumnsRenamed({"before": "b_before", "after": "b_after"})
    m = (post.join(b, "term")
         .withColumn("l", run(F.col("before"), F.col("b_before")))
         .withColumn("r", run(F.col("after"), F.col("b_after")))
         .where("l + r + 1 >= need"))
    return m.select("doc_id", "item_id", (F.col("pos") - F.col("l")).alias("start"),
                    (F.col("pos") + F.col("r")).alias("end")).distinct()


def proximity_matches(post: DataFrame, anch: DataFrame, share: float = 0.8) -> DataFrame:
    """(doc_id, item_id, pos, shared): anchors whose neighbourhood holds, in any
    order, at least ``share`` of the distinct words of the item's neighbourhood."""
    b = anch.select("term", "item_id",
                    F.array_distinct(F.concat("before", "after")).alias("near"))
    d = F.concat("before", "after")
    m = (post.join(b, "term").withColumn("shared", F.size(F.array_intersect("near", d)))
         .where(F.col("shared") >= share * F.size("near")))
    return m.groupBy("doc_id", "item_id", "pos").agg(F.max("shared").alias("shared"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  one_in: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (hits are at least one word in ``one_in``)."""
    d = docs.select("doc_id", "text")
    anch = anchors(items, d, window)
    post = postings(d, anch, window)
    found = written(phrase_matches(post, anch), "phrase-matches")
    hit = (found.select("doc_id", F.explode(F.sequence("start", "end")).alias("p"))
           .distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_hit")))
    of = (found.select("doc_id", F.col("item_id").cast("string").alias("i")).distinct()
          .groupBy("doc_id").agg(F.array_sort(F.collect_list("i")).alias("ids"),
                                 F.count(F.lit(1)).alias("n_items")))
    per_doc = null_safe(hit, of, "doc_id", "inner")
    out = null_safe(post.where("first").select("doc_id", "n_words"), per_doc, "doc_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"))
