"""Evaluation and distribution statistics as conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions.rounding import round_half_up as rhu


def _div(a: Column, b: Column) -> Column:
    """Guarded division: 0.0 when the denominator is 0 (sklearn's zero_division)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp (labels and predictions are 0/1)."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"),
                  F.count_if((y == 1) & (p == 1)).alias("tp"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """The four confusion cells, zeros included."""
    return confusion_counts(df, label, pred).select(F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, prediction, count)"))


def classification_report(df: DataFrame, label: str, pred: str,
                          names: tuple[str, str] = ("0", "1"), places: int = 6) -> DataFrame:
    """Per-class precision/recall/f1/support, accuracy, macro and weighted
    averages (rows named as in the usual text report)."""
    c = confusion_counts(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    p0, r0 = _div(tn, tn + fn), _div(tn, s0)
    p1, r1 = _div(tp, tp + fp), _div(tp, s1)
    f0, f1 = _f1(p0, r0), _f1(p1, r1)
    acc = _div(tp + tn, n)
    rows = c.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"),
        acc.alias("acc"), n.alias("n"),
        ((p0 + p1) / 2).alias("mp"), ((r0 + r1) / 2).alias("mr"), ((f0 + f1) / 2).alias("mf"),
        _div(p0 * s0 + p1 * s1, n).alias("wp"), _div(r0 * s0 + r1 * s1, n).alias("wr"),
        _div(f0 * s0 + f1 * s1, n).alias("wf"))
    long = rows.select(F.expr(
        f"stack(5, '{names[0]}', p0, r0, f0, s0, '{names[1]}', p1, r1, f1, s1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n, "
        "'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n) "
        "AS (class, precision, recall, f1_score, support)"))
    return long.select("class", rhu("precision", places).alias("precision"),
                       rhu("recall", places).alias("recall"),
                       rhu("f1_score", places).alias("f1_score"),
                       F.col("support").cast("bigint").alias("support"))


def label_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """N, positives, rate in percent (1 dp), negatives."""
    return (df.agg(F.count(F.lit(1)).alias("n"),
                   F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("positives"))
            .select("n", "positives",
                    rhu(F.try_divide(F.col("positives") * 100.0, F.col("n")), 1).alias("rate_pct"),
                    (F.col("n") - F.col("positives")).alias("negatives")))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts of one column."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), col)


def score_distribution(scored: DataFrame, places: int = 6) -> DataFrame:
    """Count, min, max, mean of the score among predicted anomalies."""
    a = scored.where(F.col("anomaly_prediction") == -1)
    return a.agg(F.count(F.lit(1)).alias("anomalies"),
                 rhu(F.min("anomaly_score"), places).alias("score_min"),
                 rhu(F.max("anomaly_score"), places).alias("score_max"),
                 rhu(F.avg("anomaly_score"), places).alias("score_mean"))


def scaler_stats(df: DataFrame, cols: list[str], places: int | None = 6) -> DataFrame:
    """Mean and population std per feature, one row per feature."""
    agg = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    long = agg.select(F.expr(f"stack({len(cols)}, {parts}) AS (feature, mean, std)"))
    if places is None:
        return long
    return long.select("feature", rhu("mean", places).alias("mean"),
                       rhu("std", places).alias("std"))


def table_count(df: DataFrame) -> DataFrame:
    """D20."""
    return df.agg(F.count(F.lit(1)).alias("records"))


def latest(df: DataFrame, ts: str) -> DataFrame:
    """Count and newest timestamp."""
    return df.agg(F.count(F.lit(1)).alias("records"), F.max(ts).alias("latest"))
