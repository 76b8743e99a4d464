"""D1-D14, F, G: layer summaries, dashboard and digest aggregations, sorts.

Every aggregation is a grouped hash aggregate (partial + final), so a hot
segment is combined map-side before the shuffle. Rounded outputs use the
decimal half-up helper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.functions.rounding import round_half_up as rhu
from leakscope.functions.timeutil import ts_lit
from leakscope.operators.lineage import as_table
from leakscope.operators.ordering import with_position
from leakscope.schemas import EVENT_ID, EVENT_TS, SEGMENT


def _flag(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _sev(name: str) -> Column:
    return F.col("severity") == name


def _avg_if(cond: Column, c: str) -> Column:
    return F.avg(F.when(cond, F.col(c)))


def CRIT() -> Column:
    return _sev("CRITICAL")


def WARN() -> Column:
    return _sev("WARNING")


def NORM() -> Column:
    return _sev("NORMAL")


def ALERTS() -> Column:
    return F.col("severity").isin("CRITICAL", "WARNING")


def positioned(df: DataFrame, *order: Column) -> DataFrame:
    """F1, F2, F4, F6, F8, F9 where the order itself is the result: ``position``
    is the row's place, 1 first. The rows are sorted by ranges over all tasks."""
    return with_position(as_table(df, "unsorted"), *order)  # read for the ranges' bounds and to be sorted


def severity_rank(col: str = "severity") -> Column:
    """CRITICAL 1, WARNING 2, anything else 3."""
    return (F.when(F.col(col) == "CRITICAL", 1).when(F.col(col) == "WARNING", 2)
            .otherwise(3))


# ---------------------------------------------------------------- layer summaries
def bronze_summary(bronze: DataFrame) -> DataFrame:
    """D1."""
    return (bronze.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("total_readings"),
        _flag(F.col("is_anomaly") == "leak").alias("leak_count"),
        _flag(F.col("is_anomaly") == "normal").alias("normal_count"),
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure"),
        rhu(F.min("pressure_psi"), 1).alias("min_pressure"),
        rhu(F.avg("acoustic_g_rms"), 4).alias("avg_acoustic"))
        .orderBy(SEGMENT))


def silver_summary(silver: DataFrame) -> DataFrame:
    """D2."""
    return (silver.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("records"),
        _flag(F.col("is_anomaly") == "leak").alias("leak_count"),
        rhu(F.avg("pressure_delta"), 2).alias("avg_pressure_delta"),
        rhu(F.avg("flow_imbalance_ratio"), 3).alias("avg_flow_imbalance"),
        rhu(F.avg("acoustic_zscore"), 3).alias("avg_acoustic_zscore"))
        .orderBy(SEGMENT))


# ---------------------------------------------------------------- dashboard
def kpi(gold: DataFrame) -> DataFrame:
    """D3: one KPI row. Pre-aggregated per segment first (map-side combine to
    one row per segment), then folded globally, so the distinct counts never
    need an Expand over the raw rows."""
    per_seg = gold.groupBy(SEGMENT).agg(
        _flag(CRIT()).alias("c"), _flag(WARN()).alias("w"), _flag(NORM()).alias("n"),
        F.sum(F.when(CRIT(), F.col("pressure_psi"))).alias("cp_sum"),
        F.count(F.when(CRIT(), F.col("pressure_psi"))).alias("cp_cnt"),
        F.min(F.when(CRIT(), F.col("pressure_psi"))).alias("cp_min"))
    return per_seg.agg(
        F.sum("c").alias("critical_events"),
        F.sum("w").alias("warning_events"),
        F.sum("n").alias("normal_events"),
        F.count(SEGMENT).alias("segments_monitored"),
        F.count(F.when(F.col("c") > 0, F.col(SEGMENT))).alias("segments_critical"),
        rhu(F.try_divide(F.sum("cp_sum"), F.sum("cp_cnt")), 1).alias("avg_critical_pressure"),
        rhu(F.min("cp_min"), 1).alias("lowest_pressure_detected"))


def segment_risk_summary(gold: DataFrame) -> DataFrame:
    """D4."""
    return (gold.groupBy(SEGMENT).agg(
        _flag(CRIT()).alias("critical_events"),
        _flag(WARN()).alias("warning_events"),
        rhu(F.min("pressure_psi"), 1).alias("min_pressure"),
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure"),
        rhu(F.max("acoustic_g_rms"), 4).alias("max_acoustic"))
        .orderBy(F.col("critical_events").desc(), SEGMENT))


def pressure_health(gold: DataFrame) -> DataFrame:
    """D5a."""
    return (gold.groupBy(SEGMENT).agg(
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure"),
        rhu(F.min("pressure_psi"), 1).alias("min_pressure"),
        rhu(F.max("pressure_psi"), 1).alias("max_pressure"),
        rhu(_avg_if(CRIT(), "pressure_psi"), 1).alias("avg_critical_pressure"),
        _flag(CRIT()).alias("critical_count"),
        _flag(WARN()).alias("warning_count"),
        rhu(F.avg("acoustic_g_rms"), 4).alias("avg_acoustic"),
        rhu(F.avg("flow_rate_lpm"), 1).alias("avg_flow"))
        .orderBy(F.col("critical_count").desc(), SEGMENT))


def score_summary(gold: DataFrame) -> DataFrame:
    """CRITICAL and WARNING rows only (partition-pruned on Gold)."""
    return (gold.where(ALERTS()).groupBy(SEGMENT).agg(
        _flag(CRIT()).alias("critical_count"),
        _flag(WARN()).alias("warning_count"),
        rhu(F.min("anomaly_score"), 4).alias("worst_anomaly_score"),
        rhu(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"),
        rhu(F.sum("anomaly_score"), 4).alias("cumulative_anomaly_impact"))
        .orderBy(F.col("critical_count").desc(), SEGMENT))


def acoustic_health(gold: DataFrame) -> DataFrame:
    """D5c."""
    return (gold.groupBy(SEGMENT).agg(
        rhu(F.avg("acoustic_g_rms"), 4).alias("avg_acoustic"),
        rhu(F.max("acoustic_g_rms"), 4).alias("max_acoustic"),
        rhu(_avg_if(NORM(), "acoustic_g_rms"), 4).alias("normal_acoustic"),
        rhu(_avg_if(CRIT(), "acoustic_g_rms"), 4).alias("critical_acoustic"),
        _flag(CRIT()).alias("critical_count"))
        .orderBy(F.col("max_acoustic").desc(), SEGMENT))


def flow_health(gold: DataFrame) -> DataFrame:
    """D5d."""
    return (gold.groupBy(SEGMENT).agg(
        rhu(F.avg("flow_rate_lpm"), 1).alias("avg_flow"),
        rhu(F.max("flow_rate_lpm"), 1).alias("max_flow"),
        rhu(_avg_if(NORM(), "flow_rate_lpm"), 1).alias("normal_flow"),
        rhu(_avg_if(CRIT(), "flow_rate_lpm"), 1).alias("critical_flow"),
        rhu(F.avg("flow_imbalance_ratio"), 3).alias("avg_imbalance_ratio"),
        rhu(F.max("flow_imbalance_ratio"), 3).alias("max_imbalance_ratio"))
        .orderBy(F.col("max_imbalance_ratio").desc(), SEGMENT))


def temperature_comparison(gold: DataFrame) -> DataFrame:
    """D5e: temp_delta = critical mean - normal mean; ordered by |delta|."""
    crit_t, norm_t = _avg_if(CRIT(), "temperature_c"), _avg_if(NORM(), "temperature_c")
    return (gold.groupBy(SEGMENT).agg(
        rhu(F.avg("temperature_c"), 1).alias("avg_temp"),
        rhu(F.max("temperature_c"), 1).alias("max_temp"),
        rhu(norm_t, 1).alias("normal_temp"),
        rhu(crit_t, 1).alias("critical_temp"),
        rhu(crit_t - norm_t, 1).alias("temp_delta"),
        _flag(CRIT()).alias("critical_count"))
        .orderBy(F.abs("temp_delta").desc(), SEGMENT))


def cumulative_impact(gold: DataFrame) -> DataFrame:
    """D5f: waterfall of summed scores over CRITICAL and WARNING rows."""
    return (gold.where(ALERTS()).groupBy(SEGMENT).agg(
        rhu(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"),
        rhu(F.min("anomaly_score"), 4).alias("worst_anomaly_score"),
        rhu(F.sum("anomaly_score"), 4).alias("cumulative_anomaly_impact"),
        _flag(CRIT()).alias("critical_count"),
        _flag(WARN()).alias("warning_count"),
        F.count(F.lit(1)).alias("total_anomalies"))
        .orderBy("cumulative_anomaly_impact", SEGMENT))


def latest_reading(gold: DataFrame) -> DataFrame:
    """E13 + B14 + F2: the latest reading of every segment, rounded for display,
    ordered CRITICAL, WARNING, other."""
    from leakscope.operators.features import latest_per_segment
    return (latest_per_segment(gold).select(
        SEGMENT, "severity",
        rhu("pressure_psi", 1).alias("pressure_psi"),
        rhu("flow_rate_lpm", 1).alias("flow_lpm"),
        rhu("acoustic_g_rms", 3).alias("acoustic_grms"),
        rhu("temperature_c", 1).alias("temp_c"),
        rhu("anomaly_score", 4).alias("anomaly_score"),
        "alert_message", EVENT_TS)
        .orderBy(severity_rank(), SEGMENT))


def critical_audit(gold: DataFrame) -> DataFrame:
    """F4 + B14: every CRITICAL row, worst score first, newest first on ties."""
    return (as_table(gold.where(CRIT()).select(
        EVENT_TS, SEGMENT, "severity",
        rhu("pressure_psi", 1).alias("pressure_psi"),
        rhu("pressure_delta", 1).alias("pressure_delta"),
        rhu("flow_rate_lpm", 1).alias("flow_lpm"),
        rhu("acoustic_g_rms", 3).alias("acoustic_grms"),
        rhu("anomaly_score", 4).alias("anomaly_score"),
        "alert_message"), "unsorted")  # read for the ranges' bounds and to be sorted
        .orderBy(F.col("anomaly_score").asc(), F.col(EVENT_TS).desc()))


def severity_distribution(gold: DataFrame) -> DataFrame:
    """G1: one row per severity level, 0 for an absent level, in one scan
    (a conditional aggregate unpivoted with ``stack``)."""
    counts = gold.agg(F.count_if(CRIT()).alias("c"), F.count_if(WARN()).alias("w"),
                      F.count_if(NORM()).alias("n"))
    return counts.select(F.expr(
        "stack(3, 'CRITICAL', c, 'WARNING', w, 'NORMAL', n) AS (severity_level, event_count)"))


# ---------------------------------------------------------------- alert digest
def critical_digest(gold: DataFrame) -> DataFrame:
    """D6 as in the alert job: per segment over CRITICAL rows; the message is
    the lexicographic maximum."""
    return (gold.where(CRIT()).groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("critical_count"),
        rhu(F.min("pressure_psi"), 1).alias("lowest_pressure_psi"),
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure_psi"),
        rhu(F.min("anomaly_score"), 4).alias("worst_anomaly_score"),
        rhu(F.avg("acoustic_g_rms"), 4).alias("avg_acoustic"),
        rhu(F.avg("flow_rate_lpm"), 1).alias("avg_flow_lpm"),
        F.max("alert_message").alias("worst_alert_message"),
        F.max(EVENT_TS).alias("last_seen"))
        .orderBy(F.col("critical_count").desc(), SEGMENT))


def critical_digest_ranked(gold: DataFrame, since=None, red_below: float = -0.10,
                           n_segments: int = 5) -> DataFrame:
    """D6 restricted to ``event_timestamp >= since``; the message of the
    lowest-scoring event (ties by event_id); priority rank by count (ties by
    segment); share of the ``n_segments`` segments that have critical events, in per
    cent; colour band red when the worst score is below ``red_below``.
    The rank window runs over the digest (one row per segment), not raw rows."""
    g = gold.where(CRIT())
    if since is not None:
        g = g.where(F.col(EVENT_TS) >= ts_lit(gold, EVENT_TS, since))
    d = g.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("critical_count"),
        rhu(F.min("pressure_psi"), 1).alias("lowest_pressure_psi"),
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure_psi"),
        F.min("anomaly_score").alias("_worst"),
        rhu(F.avg("acoustic_g_rms"), 4).alias("avg_acoustic"),
        rhu(F.avg("flow_rate_lpm"), 1).alias("avg_flow_lpm"),
        F.min_by("alert_message", F.struct("anomaly_score", EVENT_ID)).alias("worst_alert_message"),
        F.max(EVENT_TS).alias("last_seen"))
    w = Window.orderBy(F.col("critical_count").desc(), F.col(SEGMENT))
    share = rhu(F.count(F.lit(1)).over(Window.partitionBy()) * 100.0 / F.lit(n_segments), 1)
    return (d.withColumn("priority_rank", F.row_number().over(w)).withColumn("segments_share_pct", share)
            .withColumn("band", F.when(F.col("_worst") < F.lit(red_below), F.lit("red"))
                        .otherwise(F.lit("amber")))
            .withColumn("worst_anomaly_score", rhu("_worst", 4)).drop("_worst")
            .orderBy("priority_rank"))


def digest_header(digest: DataFrame, n_segments: int = 5) -> DataFrame:
    """Segments affected (of ``n_segments``), total critical events and the
    top segment (highest count, ties by segment id) with its lowest pressure."""
    top = F.min_by(F.struct(SEGMENT, "critical_count", "lowest_pressure_psi"),
                   F.struct((-F.col("critical_count")).alias("k"), F.col(SEGMENT).alias("s")))
    return (digest.agg(F.count(F.lit(1)).alias("segments_affected"),
                       F.sum("critical_count").alias("total_critical_events"),
                       top.alias("_top"))
            .select("segments_affected", F.lit(n_segments).alias("total_segments"),
                    "total_critical_events",
                    F.col(f"_top.{SEGMENT}").alias("top_segment"),
                    F.col("_top.critical_count").alias("top_critical_count"),
                    F.col("_top.lowest_pressure_psi").alias("top_lowest_pressure_psi")))


# ---------------------------------------------------------------- web app aggregates
def filtered_kpi(df: DataFrame) -> DataFrame:
    """Counts per severity, distinct critical segments, lowest pressure.
    Pre-aggregated per segment as in ``kpi``."""
    per_seg = df.groupBy(SEGMENT).agg(
        F.count_if(CRIT()).alias("c"), F.count_if(WARN()).alias("w"), F.count_if(NORM()).alias("n"),
        F.min("pressure_psi").alias("p"))
    return per_seg.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("critical"),
        F.coalesce(F.sum("w"), F.lit(0)).alias("warning"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("normal"),
        F.count(F.when(F.col("c") > 0, F.col(SEGMENT))).alias("segments_critical"),
        rhu(F.min("p"), 1).alias("lowest_pressure"))


def counts_by(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row counts per group (column ``count``)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def agg_by(df: DataFrame, key: str, col: str, fn: str, places: int | None = 4,
           alias: str | None = None, ascending: bool = True) -> DataFrame:
    """One aggregate (min/max/avg/sum) of ``col`` per ``key``, sorted by it."""
    name = alias or col
    v = getattr(F, {"mean": "avg"}.get(fn, fn))(col)
    v = rhu(v, places) if places is not None else v
    out = df.groupBy(key).agg(v.alias(name))
    return out.orderBy(F.col(name).asc() if ascending else F.col(name).desc(), key)


def segment_details(df: DataFrame) -> DataFrame:
    """Per segment event count, most frequent severity (smallest on ties),
    means of the four sensors and the worst score, 2 dp."""
    return (df.groupBy(SEGMENT).agg(
        F.count(EVENT_ID).alias("events"),
        F.mode("severity", deterministic=True).alias("severity"),
        rhu(F.avg("pressure_psi"), 2).alias("avg_pressure"),
        rhu(F.avg("flow_rate_lpm"), 2).alias("avg_flow"),
        rhu(F.avg("acoustic_g_rms"), 2).alias("avg_acoustic"),
        rhu(F.avg("temperature_c"), 2).alias("avg_temp"),
        rhu(F.min("anomaly_score"), 2).alias("worst_score"))
        .orderBy(SEGMENT))


def gold_summary(gold: DataFrame, by_segment: bool = True) -> DataFrame:
    """Events, mean pressure and worst score per severity (and segment)."""
    keys = ["severity", SEGMENT] if by_segment else ["severity"]
    return (gold.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        rhu(F.avg("pressure_psi"), 1).alias("avg_pressure"),
        rhu(F.min("anomaly_score"), 4).alias("worst_score"))
        .orderBy(*keys))


def dual_summary(dual: DataFrame) -> DataFrame:
    """Non-NORMAL dual-model rows per severity, detection source, segment."""
    return (dual.where(F.col("severity") != "NORMAL")
            .groupBy("severity", "detection_source", SEGMENT)
            .agg(F.count(F.lit(1)).alias("events"))
            .orderBy("severity", SEGMENT, "detection_source"))


# ---------------------------------------------------------------- sorts and limits
def recent(df: DataFrame, n: int = 10, by: str = "ingestion_ts",
           cols: tuple = (SEGMENT, EVENT_TS, "ingestion_ts", "pressure_psi")) -> DataFrame:
    """the ``n`` most recent rows (TakeOrderedAndProject, event_id tie-break)."""
    return (df.orderBy(F.col(by).desc(), F.col(EVENT_ID).desc()).limit(n)
            .select(*cols))


def worst_alerts(gold: DataFrame, n: int = 50) -> DataFrame:
    """the ``n`` lowest-scoring CRITICAL rows (top-k, not a global sort)."""
    return (gold.where(CRIT())
            .orderBy(F.col("anomaly_score").asc(), F.col(EVENT_ID).asc()).limit(n)
            .select(EVENT_TS, SEGMENT, "pressure_psi", "pressure_delta", "anomaly_score",
                    "alert_message"))


EXPLORE_COLUMNS = ("event_timestamp", "anomaly_score", "pressure_psi", "pipe_segment_id")


def explore(df: DataFrame, col: str = "anomaly_score", ascending: bool = True) -> DataFrame:
    """whole frame sorted by one whitelisted column (range-partitioned sort)."""
    if col not in EXPLORE_COLUMNS:
        raise ValueError(f"sort column must be one of {EXPLORE_COLUMNS}")
    c = F.col(col).asc() if ascending else F.col(col).desc()
    return as_table(df, "unsorted").orderBy(c, F.col(EVENT_ID).asc())  # read for the ranges' bounds and to be sorted


def critical_sample(gold: DataFrame, n: int = 5) -> DataFrame:
    """first ``n`` CRITICAL rows in time order."""
    return (gold.where(CRIT()).orderBy(EVENT_TS, EVENT_ID).limit(n)
            .select(SEGMENT, "pressure_psi", "pressure_delta", "acoustic_zscore",
                    "anomaly_score", "alert_message"))


def anomalies_sorted(scored: DataFrame) -> DataFrame:
    """every predicted anomaly, most anomalous first."""
    out = scored.where(F.col("anomaly_prediction") == -1).select(SEGMENT, "pressure_psi", "anomaly_score", "is_anomaly", EVENT_ID)
    return as_table(out, "unsorted").orderBy("anomaly_score", EVENT_ID)  # read for the ranges' bounds and to be sorted


def rename_for_display(df: DataFrame, mapping: dict) -> DataFrame:
    """B15."""
    return df.withColumnsRenamed(mapping)


CRITICAL_TABLE_NAMES = {"event_timestamp": "Event Time", "pipe_segment_id": "Pipe Segment",
                        "pressure_psi": "Pressure (PSI)", "pressure_delta": "Pressure Delta",
                        "anomaly_score": "Anomaly Score", "alert_message": "Alert Message"}
