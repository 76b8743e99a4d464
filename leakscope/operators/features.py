"""Per-segment window features.

Batch features (E1-E7) and micro-batch features (E8-E11) are two different
definitions in the reference and are kept apart. All trailing windows go
through ``windowing.with_halo`` so a segment is processed in (segment, time
bucket) partitions instead of one task per segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakscope.functions.rounding import round_half_up
from leakscope.operators.lineage import as_table
from leakscope.operators.windowing import (DEFAULT_BUCKET_SECONDS, TARGET_ROWS, chunk_window, drop_halo,
                                           with_halo)
from leakscope.schemas import EVENT_ID, EVENT_TS, SEGMENT, SENSORS

ORDER = [EVENT_TS, EVENT_ID]  # event_id breaks timestamp ties


def batch_features(df: DataFrame, n: int = 10, eps: float = 0.0001,
                   bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                   plan: list[DataFrame] | None = None,
                   target_rows: int = TARGET_ROWS, keep_incomplete: bool = False,
                   touched_by: str | None = None) -> DataFrame:
    """E1-E7 on quality-filtered readings.

    n-row trailing means of pressure (2 dp), flow (2 dp), acoustic (4 dp);
    previous-row pressure delta (2 dp); flow over the *rounded* flow mean (4 dp);
    n-row sample std of acoustic (4 dp); z of acoustic against the rounded mean
    and std (4 dp). Rows with any NULL (first row of a segment, single-row std)
    are dropped unless ``keep_incomplete``. With the boolean column
    ``touched_by``, ``_touched`` tells whether a row's n-row window has a row
    where it is true.
    """
    cols = df.columns
    frame = with_halo(df, SEGMENT, ORDER, EVENT_TS, n - 1, bucket_seconds, target_rows, plan)
    w = chunk_window(SEGMENT, ORDER)
    roll = w.rowsBetween(-(n - 1), 0)
    p, f, a = (F.col(c) for c in ("pressure_psi", "flow_rate_lpm", "acoustic_g_rms"))
    seen = [F.max(touched_by).over(roll).alias("_touched")] if touched_by else []
    # each window value is one column, which the rounding below reads
    out = drop_halo(frame.select(
        *cols, "_chunk", "_halo", *seen, F.avg(p).over(roll).alias("_p"), F.avg(f).over(roll).alias("_f"),
        F.avg(a).over(roll).alias("_a"), F.lag(p, 1).over(w).alias("_before"), F.stddev_samp(a).over(roll).alias("_sd")))
    out = out.withColumns({"_p2": round_half_up("_p", 2), "_f2": round_half_up("_f", 2), "_a4": round_half_up("_a", 4),
                           "_sd4": round_half_up("_sd", 4)})
    f_avg, a_avg, a_std = F.col("_f2"), F.col("_a4"), F.col("_sd4")
    out = out.withColumns({"_delta": p - F.col("_before"), "_ratio": F.try_divide(f, f_avg),
                           "_z": (a - a_avg) / (a_std + F.lit(eps))})
    if not keep_incomplete:  # on the values before rounding, which keeps null, NaN and the rest apart
        out = out.dropna(subset=[*cols, *(["_touched"] if touched_by else []), "_p", "_f", "_a", "_delta", "_ratio", "_sd", "_z"])
    return out.select(
        *cols, *(["_touched"] if touched_by else []),
        F.col("_p2").alias("pressure_rolling_avg"), f_avg.alias("flow_rolling_avg"),
        a_avg.alias("acoustic_rolling_avg"), round_half_up("_delta", 2).alias("pressure_delta"),
        round_half_up("_ratio", 4).alias("flow_imbalance_ratio"), a_std.alias("acoustic_rolling_std"),
        round_half_up("_z", 4).alias("acoustic_zscore"))


def segment_stats(df: DataFrame, col: str = "acoustic_g_rms") -> DataFrame:
    """Whole-segment mean and sample std as a grouped aggregate (partial
    aggregation, so a hot segment is combined map-side)."""
    return df.groupBy(SEGMENT).agg(F.avg(col).alias("_seg_mean"),
                                   F.stddev_samp(col).alias("_seg_std"))


def _with_segment_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach per-segment statistics. They are written first, so Spark knows
    their size: a small table is broadcast and the rows are not shuffled by
    a (possibly hot) segment key; a large one is joined by sort-merge, where
    adaptive execution splits skewed segments."""
    return df.join(as_table(stats, "segment-stats"), SEGMENT, "left")


def microbatch_features(df: DataFrame, baseline: float = 1000.0,
                        bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                        with_clock: bool = True) -> DataFrame:
    """E8-E11 (micro-batch Silver): unrounded pressure delta, flow deviation from
    ``baseline``, acoustic z against the whole batch's segment mean/std (0.0 when
    the std is 0 or NULL); rows without a delta are dropped; ``silver_ts`` added.
    """
    cols = df.columns
    frame = with_halo(df, SEGMENT, ORDER, EVENT_TS, 1, bucket_seconds)
    w = chunk_window(SEGMENT, ORDER)
    p = F.col("pressure_psi")
    out = drop_halo(frame.withColumn("pressure_delta", p - F.lag(p, 1).over(w)))
    out = _with_segment_stats(out, segment_stats(df))
    z = F.when(F.col("_seg_std") > 0, (F.col("acoustic_g_rms") - F.col("_seg_mean")) /
               F.col("_seg_std")).otherwise(F.lit(0.0))
    out = out.select(*cols, "pressure_delta",
                     ((F.col("flow_rate_lpm") - F.lit(baseline)) / F.lit(baseline))
                     .alias("flow_imbalance"),
                     z.alias("acoustic_zscore"))
    if with_clock:
        out = out.withColumn("silver_ts", F.current_timestamp())
    return out.dropna(subset=["pressure_delta"])


def sequences(df: DataFrame, cols: list[str] = SENSORS, n: int = 20,
              label: str | None = "label",
              bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
              keep_all: bool = False, plan: list[DataFrame] | None = None) -> DataFrame:
    """The n readings before each row (current row excluded) of its own
    segment as ``seq`` (array<array<double>>, oldest first). Sequences never
    cross segment borders. By default only rows with a full history are kept
    (training); ``keep_all`` keeps every row and column (scoring, where rows
    without a full history are flagged 0)."""
    keep = [EVENT_ID, SEGMENT, EVENT_TS] + ([label] if label else [])
    src = df if keep_all else df.select(*dict.fromkeys(keep + cols))
    frame = with_halo(src, SEGMENT, ORDER, EVENT_TS, n, bucket_seconds, plan=plan)
    w = chunk_window(SEGMENT, ORDER).rowsBetween(-n, -1)
    out = frame.withColumn("seq", F.collect_list(F.array(*[F.col(c).cast("double")
                                                           for c in cols])).over(w))
    out = drop_halo(out)
    if keep_all:
        return out
    return out.where(F.size("seq") == n).select(*keep, "seq")


def latest_per_segment(df: DataFrame) -> DataFrame:
    """The most recent row of each segment (ties broken by event_id).
    ``row_number() == 1`` is planned as a partial WindowGroupLimit, so only one
    row per segment and input split reaches the shuffle."""
    w = Window.partitionBy(SEGMENT).orderBy(F.col(EVENT_TS).desc(), F.col(EVENT_ID).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def minmax_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """D19 (min/max twin): one row with ``<c>_min`` and ``<c>_max``."""
    return df.agg(*[F.min(c).alias(f"{c}_min") for c in cols],
                  *[F.max(c).alias(f"{c}_max") for c in cols])


def minmax_scale(df: DataFrame, stats: dict, cols: list[str], prefix: str = "") -> DataFrame:
    """(x - min) / (max - min), 0.0 where the range is 0. ``stats`` is the
    collected single row of ``minmax_stats`` (2 x len(cols) numbers). With a
    ``prefix`` the scaled values go to new columns and the originals stay."""
    out = {}
    for c in cols:
        lo, hi = stats[f"{c}_min"], stats[f"{c}_max"]
        rng = (hi - lo) if (hi is not None and lo is not None) else None
        out[prefix + c] = (F.lit(0.0) if not rng else (F.col(c) - F.lit(lo)) / F.lit(rng))
    return df.withColumns(out)


def fit_minmax(df: DataFrame, cols: list[str]) -> dict:
    return minmax_stats(df, cols).first().asDict()
