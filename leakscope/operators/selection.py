"""Exact order statistics without one task holding all values.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here the rows are first reduced to their distinct values
with counts: equal rows, however many, are one row of that table. The wanted
ranks are located in it by narrowing a value band with ``percentile_approx``
(bounded sketch) plus exact counts until the band holds at most ``band_limit``
rows or cannot be narrowed (one value holds more). A running total over the
band gives the values at the ranks. There is one path for all sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.operators.lineage import as_table

BAND_LIMIT = 1_000_000
ACCURACY = 10_000  # sketch size ~ (1/eps) log(eps N): a few MB; narrowing repeats instead
CUTS = 64  # of the band, in one pass


def _band(df: DataFrame, value: str, k_lo: int, k_hi: int, band_limit: int, accuracy: int,
          n: int) -> tuple[DataFrame, int]:
    """Rows (``value``, _c: how many rows hold it) of a value band that contains
    the 1-based ranks ``k_lo..k_hi``; returns (band, number of rows ranked below).

    The band is cut at approximate quantiles of its distinct values (a bounded
    sketch), the rows between two cuts are counted exactly in one pass for all
    cuts, and the stretches that hold the ranks are the next band: each pass
    divides the distinct values by about half of ``CUTS``, whatever the ties."""
    v, band, below, n_band = F.col(value), df, 0, n
    while n_band > band_limit:
        found = band.agg(F.percentile_approx(value, [i / CUTS for i in range(CUTS + 1)], accuracy)).first()[0]
        cuts = sorted(set(found or []))
        if len(cuts) < 2:
            break  # one value is left
        upto = band.agg(*[F.sum(F.when(v <= F.lit(c), F.col("_c"))).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        ends = [below + (x or 0) for x in upto]  # rows ranked up to each cut; the last cut is the largest value
        first = next((i for i, e in enumerate(ends) if e >= k_lo), None)
        last = next((i for i, e in enumerate(ends) if e >= k_hi), None)
        if first is None or last is None:
            break
        start = ends[first - 1] if first else below
        if ends[last] - start >= n_band:
            break  # two values are left, one for each rank
        if first:
            band = band.where(v > F.lit(cuts[first - 1]))
        band = band.where(v <= F.lit(cuts[last]))
        below, n_band = start, ends[last] - start
    return band, below


def values_at(df: DataFrame, col: str, k_lo: int, k_hi: int, n: int, band_limit: int = BAND_LIMIT,
              accuracy: int = ACCURACY) -> DataFrame:
    """(value, first, last): the distinct values of ``df`` (``col``, _c: for how
    many rows it stands) at the 1-based ranks ``k_lo..k_hi`` of the ``n`` rows, with the
    ranks that each covers."""
    band, below = _band(df, col, k_lo, k_hi, band_limit, accuracy, n)
    # a running total over the band's distinct values only
    w = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (band.groupBy(F.col(col).alias("value")).agg(F.sum("_c").alias("_c"))
            .withColumn("last", F.sum("_c").over(w) + F.lit(below))
            .withColumn("first", F.col("last") - F.col("_c") + 1)
            .where((F.col("last") >= k_lo) & (F.col("first") <= k_hi)).drop("_c"))


def exact_quantile(df: DataFrame, col: str, q: float, alias: str = "quantile",
                   band_limit: int = BAND_LIMIT, accuracy: int = ACCURACY) -> DataFrame:
    """One-row DataFrame: the q-quantile of the non-NULL values of ``col`` with
    linear interpolation between closest ranks (same definition as
    ``percentile`` / ``quantile_cont``)."""
    # the distinct values and their counts, written once: the total and every narrowing pass read them
    kept = df.select(F.col(col).cast("double").alias(col)).where(F.col(col).isNotNull() & ~F.isnan(col))
    vals = as_table(kept.groupBy(col).agg(F.count(F.lit(1)).alias("_c")), "quantile-values")
    n = vals.agg(F.sum("_c")).first()[0] or 0
    pos = q * max(n - 1, 0)
    i = int(math.floor(pos))
    k_lo, k_hi = i + 1, max(1, min(i + 2, n))
    at = values_at(vals, col, k_lo, k_hi, n, band_limit, accuracy)
    a = F.max(F.when(F.lit(k_lo).between(F.col("first"), F.col("last")), F.col("value")))
    b = F.max(F.when(F.lit(k_hi).between(F.col("first"), F.col("last")), F.col("value")))
    return at.agg((a + (b - a) * F.lit(pos - i)).alias(alias))


def smallest_per_group(df: DataFrame, group: str, value: str, key: str, share: float,
                       rows_per_cell: int = 100_000) -> DataFrame:
    """(group, edge): per group the largest (value, key) struct among its
    ceil(share x rows) smallest; ``value`` is a hash of 52 bits. Counts per
    (group, leading bits) find the cell that holds the edge, and only that
    cell's rows are ranked, so no task sees a whole group, however large."""
    # three narrow columns, written once: the count, the cells and the ranks read them
    df = as_table(df.select(group, value, key), "group-values")
    n = df.count()
    bits = min(40, max(0, math.ceil(math.log2(max(1, n / rows_per_cell)))))
    cell = F.shiftright(F.col(value), 52 - bits)
    x = df.select(F.col(group).alias("_g"), F.col(value).alias("_v"), F.col(key).alias("_key"), cell.alias("_cell"))
    w = Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = as_table(x.groupBy("_g", "_cell").agg(F.count(F.lit(1)).alias("_c")), "group-cells").withColumn("_upto", F.sum("_c").over(w))
    want = cells.groupBy("_g").agg(F.ceil(F.lit(share) * F.sum("_c")).alias("_k"))
    # a row a group, written: where it is small, the rows of its cells are found by a broadcast
    edge = as_table(cells.join(want.withColumnRenamed("_g", "_wg"), F.col("_g").eqNullSafe(F.col("_wg")))
            .where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k")))
            .select(F.col("_g").alias("_eg"), F.col("_cell").alias("_ecell"),
                    (F.col("_k") - (F.col("_upto") - F.col("_c"))).alias("_need")), "group-edges")
    ranked = (x.join(edge, F.col("_g").eqNullSafe(F.col("_eg")) & (F.col("_cell") == F.col("_ecell")))
              .withColumn("_r", F.row_number().over(Window.partitionBy("_g").orderBy("_v", "_key"))))
    return (ranked.where("_r <= _need").groupBy(F.col("_g").alias(group))
            .agg(F.max(F.struct(F.col("_v").alias("v"), F.col("_key").alias("k"))).alias("edge")))
