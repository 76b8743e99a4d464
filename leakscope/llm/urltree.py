"""URL filter: rules first, then path templates judged by labelled purity.

A rule (host, path) decides the urls of its host and subdomains whose path
starts with the rule's; the longest rule wins. The urls that rules decide are
the labels from which the others are judged.

Each host has a tree of path segments. A segment of digits, of digits with an
extension or of hexadecimal digits is a wildcard by its form. The tree is then
walked down, ``LEVELS`` segments deep (what is deeper is one more segment):

* variable segments: a child that holds less than 1 / ``RARE`` of its parent's
  urls, of ``MANY`` or more, becomes the wildcard ``*``;
* similar branches: each child's distribution over the kinds of segments below
  it is compared with that of all the parent's children together (chi-square
  at about 0.001), and so is its labelled block rate (z of 3.29); children that
  differ in neither are merged into one branch ``~``. Comparing each child with
  the pool is linear in children.

A template (host and generalised path) is rejected when its smoothed purity,
(blocked + 1) / (labelled + 2), reaches ``PURITY``; its urls are blocked.

Only counts of (host, shaped path) go down the tree, pre-aggregated before
they are shuffled; urls meet the templates in one join whose template side has
a row for each shaped path.

Defined cases: a null url, or one without ``://``, has empty host and path and
belongs to the tree of the empty host; equal urls and repeated rows get equal
results, a row for each; a path without a slash, or an empty one, is a tree of
its root alone; templates without a label are allowed; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import ascii_lower, written

#: Fixed by the task: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

LEVELS = 4
RARE, MANY = 100, 200    # a variable segment's share, and the urls a parent needs to tell
PURITY = 0.8
Z = 3.29                 # two-sided 0.001 of the normal distribution
#: Wildcard by form: patterns that a segment matches, and its name.
FORMS = [(["^[0-9]+\\z"], "{n}"), (["^[0-9]+\\.[A-Za-z0-9]{1,5}\\z"], "{n}.{x}"),
         (["^[0-9A-Fa-f-]{8,}\\z", "[0-9]"], "{hex}")]
END = "$"                # what follows a url's last segment


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest comes to lie outside
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def shaped(path: Column, levels: int = LEVELS) -> Column:
    """``levels`` + 1 segments: wildcards by form, ``END`` after the last, and
    what is deeper as one segment at the end."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", levels + 1)

    def form(s: Column) -> Column:
        out = F.concat(F.lit("/"), s)  # no literal segment equals a wildcard
        for patterns, name in reversed(FORMS):
            out = F.when(reduce(and_, [s.rlike(p) for p in patterns]), F.lit(name)).otherwise(out)
        return out
    deep = F.transform(parts, lambda s, i: F.when(i < levels, form(s)).otherwise(F.lit("{deep}")))
    return F.concat(deep, F.array_repeat(F.lit(END), F.lit(levels + 1) - F.size(parts)))


def templates(pages: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(host, shape, template, n, good, bad) for every shaped path; n, good
    and bad are those of the whole template. ``pages`` has host, shape, label."""
    kind = [F.col("label") == x for x in ("allow", "block")]
    t = (pages.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count_if(kind[0]).alias("good"),
                                            F.count_if(kind[1]).alias("bad"))
         .withColumn("way", F.array().cast("array<string>")))
    t = written(t, "url-shapes")
    for k in range(levels):
        if k and t.where(F.col("shape")[k] != END).isEmpty():  # all urls have ended
            t = t.withColumn("way", F.concat("way", F.array_repeat(F.lit(END), levels - k)))
            break
        at = t.withColumn("seg", F.col("shape")[k])
        # variable segments
        size = written(at.groupBy("host", "way", "seg").agg(F.sum("n").alias("m")), "url-children")
        all_of = size.groupBy("host", "way").agg(F.sum("m").alias("of")).where(F.col("of") >= MANY)
        varying = (size.where(F.col("seg").startswith("/")).join(all_of, ["host", "way"])
                   .where(F.col("m") * RARE < F.col("of")).select("host", "way", "seg", F.lit("*").alias("wild")))
        at = at.join(varying, ["host", "way", "seg"], "left").withColumn("seg", F.coalesce("wild", "seg")).drop("wild")
        at = written(at, "url-level")
        alike = _alike(at.withColumn("below", _kind(F.col("shape")[k + 1])))
        t = written(at.join(alike, ["host", "way", "seg"], "left")
                    .withColumn("way", F.concat("way", F.array(F.coalesce("merged", "seg"))))
                    .select("host", "shape", "n", "good", "bad", "way"), "url-tree")
    ways = t.groupBy("host", "way").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    return t.select("host", "way", "shape").join(ways, ["host", "way"]).select(
        "host", "shape", F.array_join("way", "/").alias("template"), "n", "good", "bad")


def _kind(seg: Column) -> Column:
    """The form of a segment: all literal ones are one kind."""
    return F.when(seg.startswith("/"), F.lit("/")).otherwise(seg)


def _alike(at: DataFrame) -> DataFrame:
    """(host, way, seg, merged) of children that differ neither in what is
    below them nor in their labels from all children of their parent. A parent
    has at most max(RARE, MANY) children and the wildcards now, and a child
    a few kinds, so a parent's windows are small."""
    parent, kind = Window.partitionBy("host", "way"), Window.partitionBy("host", "way", "below")
    cells = (at.groupBy("host", "way", "seg", "below").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
             .withColumn("kinds", F.size(F.collect_set("below").over(parent)))
             .withColumn("kn", F.sum("n").over(kind)))
    x = (cells.groupBy("host", "way", "seg")
         .agg(*[F.sum(c).cast("double").alias(c) for c in ("n", "good", "bad")], F.max("kinds").alias("kinds"),
              F.sum(F.col("n").cast("double") * F.col("n") / F.col("kn")).alias("q"))
         .withColumn("all_n", F.sum("n").over(parent)).withColumn("all_bad", F.sum("bad").over(parent))
         .withColumn("all_labelled", F.sum(F.col("good") + F.col("bad")).over(parent)))
    # sum over kinds of (seen - expected)^2 / expected = (sum of seen^2 / expected) - n
    chi = F.col("q") / (F.col("n") / F.col("all_n")) - F.col("n")
    df = (F.col("kinds") - 1).cast("double")
    limit = F.when(df > 0, df * F.pow(1 - 2 / (9 * df) + F.lit(Z) * F.sqrt(2 / (9 * df)), F.lit(3.0))).otherwise(F.lit(0.0))
    labelled = F.col("good") + F.col("bad")
    rate = F.when(F.col("all_labelled") > 0, F.col("all_bad") / F.col("all_labelled")).otherwise(F.lit(0.0))
    apart = F.abs(F.col("bad") - rate * labelled) - F.lit(Z) * F.sqrt(labelled * rate * (1 - rate))
    return x.where((chi <= limit + 1e-9) & (apart <= 1e-9) & (F.col("n") < F.col("all_n"))).select(
        "host", "way", "seg", F.lit("~").alias("merged"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, levels: int = LEVELS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the url's template with its
    labelled counts. ``rules`` is a list on the driver, one
    branch of an expression each."""
    url = F.col("url")
    x = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    x = written(x.withColumn("rule", rule).withColumn("label", verdict).withColumn("shape", shaped(F.col("path"), levels)), "urls")
    t = written(templates(x, levels), "url-templates")
    purity = (F.col("bad") + 1) / (F.col("good") + F.col("bad") + 2)
    own = F.when(purity >= PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return x.join(t, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.coalesce("label", own).alias("verdict"), "template",
        F.col("good").alias("n_allow"), F.col("bad").alias("n_block"))
