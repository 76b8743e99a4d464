"""Null and physical-bound quality filter and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.schemas import BOUNDS


def _in_bounds(bounds: dict) -> list[Column]:
    return [F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()]


def quality_filter(df: DataFrame, bounds: dict = BOUNDS) -> DataFrame:
    """Keep the rows whose sensors are all within bounds (inclusive: a NULL is
    not, and a NaN sorts above any bound) and that have no NULL or NaN in any
    other column. One plain comparison a bound: nested tests of the same
    reading make a filter too large for the JVM to compile."""
    out = df
    for within in _in_bounds(bounds):
        out = out.where(within)
    others = [c for c in df.columns if c not in bounds]
    return out.dropna(subset=others) if others else out


def valid_row(df: DataFrame, bounds: dict = BOUNDS) -> Column:
    """Row-level predicate equal to ``quality_filter`` keeping the row."""
    cond = F.lit(True)
    for c in _in_bounds(bounds):
        cond = cond & F.coalesce(c, F.lit(False))
    others = [c for c in df.columns if c not in bounds]
    for c in others:
        cond = cond & F.col(c).isNotNull()
    return cond


def quality_report(df: DataFrame, bounds: dict = BOUNDS) -> DataFrame:
    """Before, after, dropped in a single pass (one partial aggregate)."""
    ok = valid_row(df, bounds)
    return (df.agg(F.count(F.lit(1)).alias("before_count"),
                   F.count_if(ok).alias("after_count"))
            .withColumn("dropped_count", F.col("before_count") - F.col("after_count")))

