"""Registered queries: name -> (spark builder, oracle SQL or None).

Every builder takes (spark, sf_dir) and returns a DataFrame computed from the
driver tables (``events`` via the fixture projections of FIXTURES.md). The
oracle is ANSI SQL over the same tables for DuckDB: fixture CTEs plus the
operator's definition written out in SQL. Rounding goes through the decimal
half-up helper on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.functions.rounding import round_half_up as rhu
from leakscope.functions.rounding import round_sql as R
from leakscope.functions.timeutil import ts_lit
from leakscope.functions.severity import (binary_label_expr, combined_severity_expr,
                                          detection_source_expr, dual_message_expr)
from leakscope.operators import filters, metrics, reports
from leakscope.operators.features import (fit_minmax, microbatch_features, minmax_scale,
                                          sequences)
from leakscope.operators.forest import (calibrate, fit_standard_scaler, standardise,
                                        stratified_split, tree_samples)
from leakscope.operators.gold import gold_table
from leakscope.operators.joins import new_only
from leakscope.operators.lineage import as_table
from leakscope.operators.quality import quality_filter, quality_report
from leakscope.operators.selection import exact_quantile
from leakscope.operators.sequence import positional_split
from leakscope.plans import medallion as M
from leakscope.schemas import (EVENT_ID, EVENT_TS, FOREST_FEATURES, GOLD_COLUMNS, SEGMENT,
                               SENSORS)
from leakscope.sources import fixtures as fx
from leakscope.sources.messages import parse_json, parse_messages, to_messages
from leakscope.sources.tables import audit

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def SF(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def CI(cond: str) -> str:
    return f"CAST(COUNT(CASE WHEN {cond} THEN 1 END) AS BIGINT)"


def G(body: str) -> str:
    return fx.with_fixtures(body, "fx_gold")


def S(body: str) -> str:
    return fx.with_fixtures(body, "fx_silver")


def B(body: str) -> str:
    return fx.with_fixtures(body, "fx_bronze")


bronze, silver, gold = M.fixture_bronze, M.fixture_silver, M.fixture_gold
CRIT, WARN, NORM = "severity = 'CRITICAL'", "severity = 'WARNING'", "severity = 'NORMAL'"
LEAK, NORMAL_ROW = "is_anomaly = 'leak'", "is_anomaly = 'normal'"
VALID = ("pressure_psi BETWEEN 100.0 AND 3000.0 AND flow_rate_lpm BETWEEN 0.0 AND 600.0 "
         "AND acoustic_g_rms BETWEEN 0.0 AND 10.0 AND temperature_c BETWEEN -20.0 AND 200.0 "
         "AND event_id IS NOT NULL AND pipe_segment_id IS NOT NULL AND event_timestamp IS NOT NULL "
         "AND is_anomaly IS NOT NULL AND ingestion_ts IS NOT NULL")

# Fixed query parameters used by the filter queries.
SEGMENT_PICK = ["PIPE-001", "PIPE-003"]
SEVERITY_PICK = ["CRITICAL", "WARNING"]
RANGE_START, RANGE_END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
DIGEST_SINCE = dt.datetime(2024, 1, 10)
BACKFILL_CUT = dt.datetime(2024, 1, 15)


# ============================================================== A: audit
@query("A13_audit", fx.with_fixtures(
    "SELECT 'bronze_sensor_raw' AS table_name, COUNT(*) AS records, MAX(ingestion_ts) AS latest, 'ok' AS status FROM fx_bronze "
    "UNION ALL SELECT 'silver_sensor_clean', (SELECT COUNT(*) FROM fx_silver), CAST(NULL AS TIMESTAMP), 'missing column silver_ts' "
    "UNION ALL SELECT 'gold_alerts', (SELECT COUNT(*) FROM fx_gold), (SELECT MAX(event_timestamp) FROM fx_gold), 'ok'",
    "fx_gold"))
def a13(spark, sf):
    s = silver(spark, sf)
    return audit([("bronze_sensor_raw", bronze(spark, sf), "ingestion_ts"),
                  ("silver_sensor_clean", s, "silver_ts"),
                  ("gold_alerts", M.standin_gold(s), "event_timestamp")])


# ============================================================== B: parse, filter
@query("B1_parse_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def b1(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select(EVENT_ID, parse_json(F.col("props"), "k INT").getField("k").alias("k"))


@query("B5_quality_filter", B(f"SELECT * FROM fx_bronze WHERE {VALID}"))
def b5(spark, sf):
    return quality_filter(bronze(spark, sf))


@query("B6_quality_report", B(
    f"SELECT COUNT(*) AS before_count, {CI(VALID)} AS after_count, "
    f"COUNT(*) - {CI(VALID)} AS dropped_count FROM fx_bronze"))
def b6(spark, sf):
    return quality_report(bronze(spark, sf))


@query("B7_filter_membership", G(
    "SELECT event_id, pipe_segment_id, severity, pressure_psi, anomaly_score FROM fx_gold "
    "WHERE pipe_segment_id IN ('PIPE-001', 'PIPE-003') AND severity IN ('CRITICAL', 'WARNING')"))
def b7(spark, sf):
    return (filters.filter_gold(gold(spark, sf), SEGMENT_PICK, SEVERITY_PICK)
            .select(EVENT_ID, SEGMENT, "severity", "pressure_psi", "anomaly_score"))


@query("B8_date_range_as_coded", G(
    "SELECT event_id, event_timestamp, severity FROM fx_gold WHERE event_timestamp >= TIMESTAMP '2024-01-05 00:00:00' "
    "AND event_timestamp <= TIMESTAMP '2024-01-20 00:00:00'"))
def b8(spark, sf):
    return (filters.filter_gold(gold(spark, sf), start=RANGE_START, end=RANGE_END)
            .select(EVENT_ID, EVENT_TS, "severity"))


@query("B9_date_range_repaired", G(
    "SELECT event_id, event_timestamp, severity FROM fx_gold WHERE event_timestamp >= TIMESTAMP '2024-01-05 00:00:00' "
    "AND event_timestamp < TIMESTAMP '2024-01-21 00:00:00'"))
def b9(spark, sf):
    return (filters.filter_gold(gold(spark, sf), start=RANGE_START, end=RANGE_END,
                                inclusive_end=False)
            .select(EVENT_ID, EVENT_TS, "severity"))


@query("B10_severity_filter", G(f"SELECT event_id, severity FROM fx_gold WHERE severity <> 'NORMAL'"))
def b10(spark, sf):
    return filters.severity_is(gold(spark, sf), "NORMAL", negate=True).select(EVENT_ID, "severity")


@query("B11_coerce", "SELECT event_id, TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_text, "
       "TRY_CAST(event_type AS DOUBLE) AS event_type FROM events")
def b11(spark, sf):
    ev = fx.table(spark, sf, "events").select(EVENT_ID, F.col("value").cast("string")
                                              .alias("value_text"), "event_type")
    return filters.coerce(ev, numeric=["value_text", "event_type"])


@query("B14_round_columns", G(
    f"SELECT event_id, {R('pressure_psi', 1)} AS pressure_psi, {R('acoustic_g_rms', 3)} AS acoustic_g_rms, "
    f"{R('anomaly_score', 4)} AS anomaly_score FROM fx_gold"))
def b14(spark, sf):
    g = gold(spark, sf).select(EVENT_ID, "pressure_psi", "acoustic_g_rms", "anomaly_score")
    return filters.round_columns(g, {"pressure_psi": 1, "acoustic_g_rms": 3, "anomaly_score": 4})


@query("B15_critical_table_renamed", G(
    'SELECT event_timestamp AS "Event Time", pipe_segment_id AS "Pipe Segment", pressure_psi AS "Pressure (PSI)", '
    'pressure_delta AS "Pressure Delta", anomaly_score AS "Anomaly Score", alert_message AS "Alert Message" '
    f"FROM fx_gold WHERE {CRIT} ORDER BY anomaly_score, event_id LIMIT 50"))
def b15(spark, sf):
    return reports.rename_for_display(reports.worst_alerts(gold(spark, sf), 50),
                                      reports.CRITICAL_TABLE_NAMES)


@query("B16_segments", B("SELECT DISTINCT pipe_segment_id FROM fx_bronze WHERE pipe_segment_id IS NOT NULL"))
def b16(spark, sf):
    return filters.segments(bronze(spark, sf))


@query("B16_date_bounds", G("SELECT CAST(MIN(event_timestamp) AS DATE) AS min_date, "
                            "CAST(MAX(event_timestamp) AS DATE) AS max_date FROM fx_gold"))
def b16b(spark, sf):
    return filters.date_bounds(gold(spark, sf))


@query("B2_B3_message_round_trip", B(
    "SELECT event_id, pipe_segment_id, event_timestamp, pressure_psi, flow_rate_lpm, acoustic_g_rms, temperature_c, "
    "is_anomaly FROM fx_bronze"))
def b2_b3(spark, sf):
    """A15 then B1-B3: Bronze rows as messages and parsed back."""
    rows = parse_messages(to_messages(bronze(spark, sf)), with_clock=False)
    return rows.withColumn(EVENT_TS, F.col(EVENT_TS).cast("timestamp_ntz"))


@query("B12_gold_projection", G(
    "SELECT " + ", ".join(GOLD_COLUMNS) + " FROM fx_gold"))
def b12(spark, sf):
    return gold_table(gold(spark, sf), with_clock=False)


# ============================================================== C: joins
@query("C2_backfill_new_only", B(
    "SELECT event_id, pipe_segment_id, event_timestamp FROM fx_bronze n WHERE NOT EXISTS "
    "(SELECT 1 FROM fx_bronze e WHERE e.event_timestamp < TIMESTAMP '2024-01-15 00:00:00' AND e.event_id = n.event_id)"))
def c2(spark, sf):
    b = bronze(spark, sf)
    existing = b.where(F.col(EVENT_TS) < ts_lit(b, EVENT_TS, BACKFILL_CUT))
    return new_only(b, existing).select(EVENT_ID, SEGMENT, EVENT_TS)


# ============================================================== D: aggregations
@query("D1_bronze_summary", B(
    f"SELECT pipe_segment_id, COUNT(*) AS total_readings, {SF(LEAK)} AS leak_count, "
    f"{SF(NORMAL_ROW)} AS normal_count, {R('AVG(pressure_psi)', 1)} AS avg_pressure, "
    f"{R('MIN(pressure_psi)', 1)} AS min_pressure, {R('AVG(acoustic_g_rms)', 4)} AS avg_acoustic "
    "FROM fx_bronze GROUP BY pipe_segment_id"))
def d1(spark, sf):
    return reports.bronze_summary(bronze(spark, sf))


@query("D2_silver_summary", S(
    f"SELECT pipe_segment_id, COUNT(*) AS records, {SF(LEAK)} AS leak_count, "
    f"{R('AVG(pressure_delta)', 2)} AS avg_pressure_delta, {R('AVG(flow_imbalance_ratio)', 3)} AS avg_flow_imbalance, "
    f"{R('AVG(acoustic_zscore)', 3)} AS avg_acoustic_zscore FROM fx_silver GROUP BY pipe_segment_id"))
def d2(spark, sf):
    return reports.silver_summary(silver(spark, sf))


@query("D3_kpi", G(
    f"SELECT {SF(CRIT)} AS critical_events, {SF(WARN)} AS warning_events, {SF(NORM)} AS normal_events, "
    "COUNT(DISTINCT pipe_segment_id) AS segments_monitored, "
    f"COUNT(DISTINCT CASE WHEN {CRIT} THEN pipe_segment_id END) AS segments_critical, "
    f"{R(f'AVG(CASE WHEN {CRIT} THEN pressure_psi END)', 1)} AS avg_critical_pressure, "
    f"{R(f'MIN(CASE WHEN {CRIT} THEN pressure_psi END)', 1)} AS lowest_pressure_detected FROM fx_gold"))
def d3(spark, sf):
    return reports.kpi(gold(spark, sf))


@query("D4_segment_risk_summary", G(
    f"SELECT pipe_segment_id, {SF(CRIT)} AS critical_events, {SF(WARN)} AS warning_events, "
    f"{R('MIN(pressure_psi)', 1)} AS min_pressure, {R('AVG(pressure_psi)', 1)} AS avg_pressure, "
    f"{R('MAX(acoustic_g_rms)', 4)} AS max_acoustic FROM fx_gold GROUP BY pipe_segment_id"))
def d4(spark, sf):
    return reports.segment_risk_summary(gold(spark, sf))


@query("D5a_pressure_health", G(
    f"SELECT pipe_segment_id, {R('AVG(pressure_psi)', 1)} AS avg_pressure, {R('MIN(pressure_psi)', 1)} AS min_pressure, "
    f"{R('MAX(pressure_psi)', 1)} AS max_pressure, {R(f'AVG(CASE WHEN {CRIT} THEN pressure_psi END)', 1)} AS avg_critical_pressure, "
    f"{SF(CRIT)} AS critical_count, {SF(WARN)} AS warning_count, {R('AVG(acoustic_g_rms)', 4)} AS avg_acoustic, "
    f"{R('AVG(flow_rate_lpm)', 1)} AS avg_flow FROM fx_gold GROUP BY pipe_segment_id"))
def d5a(spark, sf):
    return reports.pressure_health(gold(spark, sf))


@query("D5b_score_summary", G(
    f"SELECT pipe_segment_id, {SF(CRIT)} AS critical_count, {SF(WARN)} AS warning_count, "
    f"{R('MIN(anomaly_score)', 4)} AS worst_anomaly_score, {R('AVG(anomaly_score)', 4)} AS avg_anomaly_score, "
    f"{R('SUM(anomaly_score)', 4)} AS cumulative_anomaly_impact FROM fx_gold "
    "WHERE severity IN ('CRITICAL', 'WARNING') GROUP BY pipe_segment_id"))
def d5b(spark, sf):
    return reports.score_summary(gold(spark, sf))


@query("D5c_acoustic_health", G(
    f"SELECT pipe_segment_id, {R('AVG(acoustic_g_rms)', 4)} AS avg_acoustic, {R('MAX(acoustic_g_rms)', 4)} AS max_acoustic, "
    f"{R(f'AVG(CASE WHEN {NORM} THEN acoustic_g_rms END)', 4)} AS normal_acoustic, "
    f"{R(f'AVG(CASE WHEN {CRIT} THEN acoustic_g_rms END)', 4)} AS critical_acoustic, "
    f"{SF(CRIT)} AS critical_count FROM fx_gold GROUP BY pipe_segment_id"))
def d5c(spark, sf):
    return reports.acoustic_health(gold(spark, sf))


@query("D5d_flow_health", G(
    f"SELECT pipe_segment_id, {R('AVG(flow_rate_lpm)', 1)} AS avg_flow, {R('MAX(flow_rate_lpm)', 1)} AS max_flow, "
    f"{R(f'AVG(CASE WHEN {NORM} THEN flow_rate_lpm END)', 1)} AS normal_flow, "
    f"{R(f'AVG(CASE WHEN {CRIT} THEN flow_rate_lpm END)', 1)} AS critical_flow, "
    f"{R('AVG(flow_imbalance_ratio)', 3)} AS avg_imbalance_ratio, {R('MAX(flow_imbalance_ratio)', 3)} AS max_imbalance_ratio "
    "FROM fx_gold GROUP BY pipe_segment_id"))
def d5d(spark, sf):
    return reports.flow_health(gold(spark, sf))


_CT, _NT = f"AVG(CASE WHEN {CRIT} THEN temperature_c END)", f"AVG(CASE WHEN {NORM} THEN temperature_c END)"


@query("D5e_temperature_comparison", G(
    f"SELECT pipe_segment_id, {R('AVG(temperature_c)', 1)} AS avg_temp, {R('MAX(temperature_c)', 1)} AS max_temp, "
    f"{R(_NT, 1)} AS normal_temp, {R(_CT, 1)} AS critical_temp, {R(f'{_CT} - {_NT}', 1)} AS temp_delta, "
    f"{SF(CRIT)} AS critical_count FROM fx_gold GROUP BY pipe_segment_id"))
def d5e(spark, sf):
    return reports.temperature_comparison(gold(spark, sf))


@query("D5f_cumulative_impact", G(
    f"SELECT pipe_segment_id, {R('AVG(anomaly_score)', 4)} AS avg_anomaly_score, {R('MIN(anomaly_score)', 4)} AS worst_anomaly_score, "
    f"{R('SUM(anomaly_score)', 4)} AS cumulative_anomaly_impact, {SF(CRIT)} AS critical_count, {SF(WARN)} AS warning_count, "
    "COUNT(*) AS total_anomalies FROM fx_gold WHERE severity IN ('CRITICAL', 'WARNING') GROUP BY pipe_segment_id"))
def d5f(spark, sf):
    return reports.cumulative_impact(gold(spark, sf))


_DIGEST = (f"SELECT pipe_segment_id, COUNT(*) AS critical_count, {R('MIN(pressure_psi)', 1)} AS lowest_pressure_psi, "
           f"{R('AVG(pressure_psi)', 1)} AS avg_pressure_psi, {R('MIN(anomaly_score)', 4)} AS worst_anomaly_score, "
           f"{R('AVG(acoustic_g_rms)', 4)} AS avg_acoustic, {R('AVG(flow_rate_lpm)', 1)} AS avg_flow_lpm, "
           "MAX(alert_message) AS worst_alert_message, MAX(event_timestamp) AS last_seen "
           f"FROM fx_gold WHERE {CRIT} GROUP BY pipe_segment_id")


@query("D6_critical_digest", G(_DIGEST))
def d6(spark, sf):
    return reports.critical_digest(gold(spark, sf))


@query("D7_critical_digest_ranked", G(
    f"SELECT pipe_segment_id, COUNT(*) AS critical_count, {R('MIN(pressure_psi)', 1)} AS lowest_pressure_psi, "
    f"{R('AVG(pressure_psi)', 1)} AS avg_pressure_psi, {R('AVG(acoustic_g_rms)', 4)} AS avg_acoustic, "
    f"{R('AVG(flow_rate_lpm)', 1)} AS avg_flow_lpm, "
    "FIRST(alert_message ORDER BY anomaly_score, event_id) AS worst_alert_message, MAX(event_timestamp) AS last_seen, "
    "CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, pipe_segment_id) AS INTEGER) AS priority_rank, "
    f"{R('COUNT(*) OVER () * 100.0 / 5', 1)} AS segments_share_pct, "
    "CASE WHEN MIN(anomaly_score) < -0.10 THEN 'red' ELSE 'amber' END AS band, "
    f"{R('MIN(anomaly_score)', 4)} AS worst_anomaly_score "
    f"FROM fx_gold WHERE {CRIT} AND event_timestamp >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY pipe_segment_id"))
def d7(spark, sf):
    return reports.critical_digest_ranked(gold(spark, sf), since=DIGEST_SINCE)


@query("D8_digest_header", fx.with_fixtures(
    "SELECT CAST(COUNT(*) AS BIGINT) AS segments_affected, 5 AS total_segments, "
    "CAST(SUM(critical_count) AS BIGINT) AS total_critical_events, "
    "FIRST(pipe_segment_id ORDER BY critical_count DESC, pipe_segment_id) AS top_segment, "
    "FIRST(critical_count ORDER BY critical_count DESC, pipe_segment_id) AS top_critical_count, "
    "FIRST(lowest_pressure_psi ORDER BY critical_count DESC, pipe_segment_id) AS top_lowest_pressure_psi FROM digest",
    "fx_gold", extra=[("digest", _DIGEST)]))
def d8(spark, sf):
    return reports.digest_header(reports.critical_digest(gold(spark, sf)), 5)


@query("D9_filtered_kpi", G(
    f"SELECT {SF(CRIT)} AS critical, {SF(WARN)} AS warning, {SF(NORM)} AS normal, "
    f"COUNT(DISTINCT CASE WHEN {CRIT} THEN pipe_segment_id END) AS segments_critical, "
    f"{R('MIN(pressure_psi)', 1)} AS lowest_pressure FROM fx_gold "
    "WHERE event_timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND event_timestamp <= TIMESTAMP '2024-01-20 00:00:00'"))
def d9(spark, sf):
    return reports.filtered_kpi(filters.filter_gold(gold(spark, sf), start=RANGE_START,
                                                    end=RANGE_END))


@query("D10_counts_segment_severity", G(
    'SELECT pipe_segment_id, severity, COUNT(*) AS "count" FROM fx_gold GROUP BY pipe_segment_id, severity'))
def d10(spark, sf):
    return reports.counts_by(gold(spark, sf), [SEGMENT, "severity"])


@query("D10_counts_severity", G('SELECT severity, COUNT(*) AS "count" FROM fx_gold GROUP BY severity'))
def d10b(spark, sf):
    return reports.counts_by(gold(spark, sf), ["severity"])


@query("D11_worst_score_by_segment", G(
    f"SELECT pipe_segment_id, {R('MIN(anomaly_score)', 4)} AS worst_score FROM fx_gold GROUP BY pipe_segment_id"))
def d11a(spark, sf):
    return reports.agg_by(gold(spark, sf), SEGMENT, "anomaly_score", "min", 4, "worst_score")


@query("D11_avg_pressure_by_severity", G(
    f"SELECT severity, {R('AVG(pressure_psi)', 4)} AS avg_pressure FROM fx_gold GROUP BY severity"))
def d11b(spark, sf):
    return reports.agg_by(gold(spark, sf), "severity", "pressure_psi", "avg", 4, "avg_pressure")


@query("D11_score_sum_by_segment", G(
    f"SELECT pipe_segment_id, {R('SUM(anomaly_score)', 4)} AS score_sum FROM fx_gold GROUP BY pipe_segment_id"))
def d11c(spark, sf):
    return reports.agg_by(gold(spark, sf), SEGMENT, "anomaly_score", "sum", 4, "score_sum")


@query("D12_segment_details", G(
    "WITH m AS (SELECT pipe_segment_id, severity, ROW_NUMBER() OVER (PARTITION BY pipe_segment_id "
    "ORDER BY COUNT(*) DESC, severity) AS rn FROM fx_gold GROUP BY pipe_segment_id, severity), "
    f"a AS (SELECT pipe_segment_id, COUNT(event_id) AS events, {R('AVG(pressure_psi)', 2)} AS avg_pressure, "
    f"{R('AVG(flow_rate_lpm)', 2)} AS avg_flow, {R('AVG(acoustic_g_rms)', 2)} AS avg_acoustic, "
    f"{R('AVG(temperature_c)', 2)} AS avg_temp, {R('MIN(anomaly_score)', 2)} AS worst_score FROM fx_gold GROUP BY pipe_segment_id) "
    "SELECT a.pipe_segment_id, a.events, m.severity, a.avg_pressure, a.avg_flow, a.avg_acoustic, a.avg_temp, a.worst_score "
    "FROM a JOIN m ON a.pipe_segment_id = m.pipe_segment_id AND m.rn = 1"))
def d12(spark, sf):
    return reports.segment_details(gold(spark, sf))


@query("D13_gold_summary", G(
    f"SELECT severity, pipe_segment_id, COUNT(*) AS events, {R('AVG(pressure_psi)', 1)} AS avg_pressure, "
    f"{R('MIN(anomaly_score)', 4)} AS worst_score FROM fx_gold GROUP BY severity, pipe_segment_id"))
def d13(spark, sf):
    return reports.gold_summary(gold(spark, sf), by_segment=True)


@query("D13_gold_summary_by_severity", G(
    f"SELECT severity, COUNT(*) AS events, {R('AVG(pressure_psi)', 1)} AS avg_pressure, "
    f"{R('MIN(anomaly_score)', 4)} AS worst_score FROM fx_gold GROUP BY severity"))
def d13b(spark, sf):
    return reports.gold_summary(gold(spark, sf), by_segment=False)


# dual-model frame: fixture flags on Gold + H3..H5
def dual(spark, sf) -> DataFrame:
    g = fx.dual_flags(gold(spark, sf))
    g = g.withColumn("severity", combined_severity_expr())
    g = g.withColumn("detection_source", detection_source_expr())
    return g.withColumn("alert_message", dual_message_expr())


_TRIG = fx.TRIGGER_TEXTS
_DUAL = (
    f"WITH f AS (SELECT fx_gold.* EXCLUDE (severity, alert_message), {fx.FX_DUAL_FLAGS_SQL[0]} AS if_anomaly, "
    f"{fx.FX_DUAL_FLAGS_SQL[1]} AS lstm_anomaly FROM fx_gold), "
    "s AS (SELECT f.*, CASE WHEN if_anomaly = 1 AND lstm_anomaly = 1 THEN 'CRITICAL' WHEN if_anomaly = 1 OR lstm_anomaly = 1 "
    "THEN 'WARNING' ELSE 'NORMAL' END AS severity, CASE WHEN if_anomaly = 1 AND lstm_anomaly = 1 THEN 'BOTH' "
    "WHEN if_anomaly = 1 THEN 'IF_ONLY' WHEN lstm_anomaly = 1 THEN 'LSTM_ONLY' ELSE 'NONE' END AS detection_source FROM f) "
    "SELECT s.*, CASE WHEN severity = 'NORMAL' THEN '' WHEN pressure_delta < -100 OR flow_imbalance_ratio > 1.25E0 "
    "OR ABS(acoustic_zscore) > 2.0E0 OR detection_source IN ('LSTM_ONLY', 'BOTH') THEN CONCAT_WS('; ', " + _TRIG +
    ", CASE WHEN detection_source = 'LSTM_ONLY' THEN 'Slow leak trend detected by LSTM' "
    "WHEN detection_source = 'BOTH' THEN 'Confirmed by both IF and LSTM' END) ELSE 'Multi-sensor anomaly' END AS alert_message FROM s")


def DU(body: str) -> str:
    return fx.with_fixtures(body, "fx_gold", extra=[("dual", _DUAL)])


@query("D14_dual_summary", DU(
    "SELECT severity, detection_source, pipe_segment_id, COUNT(*) AS events FROM dual WHERE severity <> 'NORMAL' "
    "GROUP BY severity, detection_source, pipe_segment_id"))
def d14(spark, sf):
    return reports.dual_summary(dual(spark, sf))


_LP = "(SELECT CASE WHEN is_anomaly = 'leak' THEN 1 ELSE 0 END AS y, CASE WHEN anomaly_prediction = -1 THEN 1 ELSE 0 END AS p FROM fx_gold)"
_CONF = (f"SELECT {SF('y = 0 AND p = 0')} AS tn, {SF('y = 0 AND p = 1')} AS fp, {SF('y = 1 AND p = 0')} AS fn, "
         f"{SF('y = 1 AND p = 1')} AS tp FROM {_LP}")


def _labelled_gold(spark, sf):
    return gold(spark, sf).select(
        binary_label_expr("is_anomaly", positive="leak").alias("y"),
        F.when(F.col("anomaly_prediction") == -1, 1).otherwise(0).alias("p"))


def _dv(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _f1s(p, r):
    return f"CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"


def report_sql(confusion: str, base: str, extra: list[tuple[str, str]] = (), names: tuple[str, str] = ("0", "1")) -> str:
    """D15 from the SQL of a row of tn, fp, fn, tp."""
    return fx.with_fixtures(
        "SELECT class, " + R("precision", 6) + " AS precision, " + R("recall", 6) + " AS recall, "
        + R("f1_score", 6) + " AS f1_score, CAST(support AS BIGINT) AS support FROM ("
        f"SELECT '{names[0]}' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM q UNION ALL "
        f"SELECT '{names[1]}', p1, r1, f1, s1 FROM q UNION ALL "
        "SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n FROM q UNION ALL "
        "SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM q UNION ALL "
        f"SELECT 'weighted avg', {_dv('p0 * s0 + p1 * s1', 'n')}, {_dv('r0 * s0 + r1 * s1', 'n')}, "
        f"{_dv('f0 * s0 + f1 * s1', 'n')}, n FROM q)",
        base, extra=[*extra, ("c", confusion),
                          ("r", f"SELECT tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n, {_dv('tn', 'tn + fn')} AS p0, "
                                f"{_dv('tn', 'tn + fp')} AS r0, {_dv('tp', 'tp + fp')} AS p1, {_dv('tp', 'fn + tp')} AS r1, "
                                f"{_dv('tp + tn', 'tn + fp + fn + tp')} AS acc FROM c"),
                          ("q", f"SELECT r.*, {_f1s('p0', 'r0')} AS f0, {_f1s('p1', 'r1')} AS f1 FROM r")])


_REPORT = report_sql(_CONF, "fx_gold")


@query("D15_classification_report", _REPORT)
def d15(spark, sf):
    return metrics.classification_report(_labelled_gold(spark, sf), "y", "p")


@query("D15_confusion", fx.with_fixtures(
    'SELECT 0 AS label, 0 AS prediction, tn AS "count" FROM c UNION ALL SELECT 0, 1, fp FROM c '
    "UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c", "fx_gold", extra=[("c", _CONF)]))
def d15b(spark, sf):
    return metrics.confusion(_labelled_gold(spark, sf), "y", "p")


_COMBINED = ("SELECT pipe_segment_id, event_timestamp, pressure_psi, flow_rate_lpm, acoustic_g_rms, temperature_c, is_anomaly, "
             "CASE WHEN is_anomaly <> 'normal' THEN 1 ELSE 0 END AS label FROM fx_silver UNION ALL "
             "SELECT pipe_segment_id, event_timestamp, pressure_psi, flow_rate_lpm, acoustic_g_rms, temperature_c, is_anomaly, "
             "CASE WHEN is_anomaly <> 'normal' THEN 1 ELSE 0 END FROM fx_slow_leak")


def combined(spark, sf) -> DataFrame:
    """Silver and slow-leak rows stacked by name with a 0/1 label."""
    keep = [SEGMENT, EVENT_TS] + SENSORS + ["is_anomaly"]
    a = silver(spark, sf).select(*keep)
    b = fx.slow_leak(spark, sf).select(*keep)
    return a.unionByName(b).withColumn("label", binary_label_expr("is_anomaly"))


@query("D16_label_balance", fx.with_fixtures(
    f"SELECT COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS positives, {R('SUM(label) * 100.0 / COUNT(*)', 1)} AS rate_pct, "
    "COUNT(*) - CAST(SUM(label) AS BIGINT) AS negatives FROM combined", "fx_silver", "fx_slow_leak",
    extra=[("combined", _COMBINED)]))
def d16(spark, sf):
    return metrics.label_balance(combined(spark, sf), "label")


@query("D17_severity_distribution", G('SELECT severity, COUNT(*) AS "count" FROM fx_gold GROUP BY severity'))
def d17(spark, sf):
    return metrics.distribution(gold(spark, sf), "severity")


@query("D17_detection_source_distribution", DU(
    'SELECT detection_source, COUNT(*) AS "count" FROM dual GROUP BY detection_source'))
def d17b(spark, sf):
    return metrics.distribution(dual(spark, sf), "detection_source")


@query("D18_score_distribution", G(
    f"SELECT COUNT(*) AS anomalies, {R('MIN(anomaly_score)', 6)} AS score_min, {R('MAX(anomaly_score)', 6)} AS score_max, "
    f"{R('AVG(anomaly_score)', 6)} AS score_mean FROM fx_gold WHERE anomaly_prediction = -1"))
def d18(spark, sf):
    return metrics.score_distribution(gold(spark, sf))


@query("D19_scaler_stats", S(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {R(f'AVG({c})', 6)} AS mean, {R(f'STDDEV_POP({c})', 6)} AS std FROM fx_silver"
    for c in FOREST_FEATURES)))
def d19(spark, sf):
    return metrics.scaler_stats(silver(spark, sf), FOREST_FEATURES)


@query("D19_minmax_stats", fx.with_fixtures(
    "SELECT " + ", ".join(f"MIN({c}) AS {c}_min" for c in SENSORS) + ", "
    + ", ".join(f"MAX({c}) AS {c}_max" for c in SENSORS) + " FROM fx_slow_leak", "fx_slow_leak"))
def d19b(spark, sf):
    from leakscope.operators.features import minmax_stats
    return minmax_stats(fx.slow_leak(spark, sf), SENSORS)


@query("D20_bronze_latest", B("SELECT COUNT(*) AS records, MAX(ingestion_ts) AS latest FROM fx_bronze"))
def d20(spark, sf):
    return metrics.latest(bronze(spark, sf), "ingestion_ts")


# ============================================================== E: windows
@query("E1_E7_batch_features", S("SELECT * FROM fx_silver"))
def e_all(spark, sf):
    return silver(spark, sf)


for _i, _c in enumerate(["pressure_rolling_avg", "flow_rolling_avg", "acoustic_rolling_avg",
                         "pressure_delta", "flow_imbalance_ratio", "acoustic_rolling_std",
                         "acoustic_zscore"], start=1):
    def _mk(c):
        def fn(spark, sf):
            return silver(spark, sf).select(EVENT_ID, SEGMENT, c)
        return fn
    query(f"E{_i}_{_c}", S(f"SELECT event_id, pipe_segment_id, {_c} FROM fx_silver"))(_mk(_c))


@query("E1_E7_small_buckets", S("SELECT * FROM fx_silver"))
def e_small(spark, sf):
    """E1-E7 with buckets of about 100 rows: many buckets and their halos."""
    return M.silver(fx.bronze_parsed(spark, sf), target_rows=100)


_MB = ("WITH b AS (SELECT * FROM fx_bronze), st AS (SELECT pipe_segment_id, AVG(acoustic_g_rms) AS m, "
       "STDDEV_SAMP(acoustic_g_rms) AS sd FROM b GROUP BY pipe_segment_id), "
       "f AS (SELECT b.event_id, b.pipe_segment_id, b.pressure_psi - LAG(b.pressure_psi) OVER (PARTITION BY b.pipe_segment_id "
       "ORDER BY b.event_timestamp, b.event_id) AS d, (b.flow_rate_lpm - 1000.0E0) / 1000.0E0 AS fi, "
       "CASE WHEN st.sd > 0 THEN (b.acoustic_g_rms - st.m) / st.sd ELSE 0.0E0 END AS z FROM b JOIN st ON b.pipe_segment_id = st.pipe_segment_id) "
       f"SELECT event_id, pipe_segment_id, {R('d', 6)} AS pressure_delta, {R('fi', 6)} AS flow_imbalance, "
       f"{R('z', 6)} AS acoustic_zscore FROM f WHERE d IS NOT NULL")


@query("E8_E11_microbatch_features", B(_MB))
def e8(spark, sf):
    m = microbatch_features(bronze(spark, sf), with_clock=False)
    return m.select(EVENT_ID, SEGMENT, rhu("pressure_delta", 6).alias("pressure_delta"),
                    rhu("flow_imbalance", 6).alias("flow_imbalance"),
                    rhu("acoustic_zscore", 6).alias("acoustic_zscore"))


_SEQ = ", ".join(f"LIST({c}) OVER w AS l{i}" for i, c in enumerate(SENSORS))


@query("E12_sequences", fx.with_fixtures(
    "SELECT event_id, pipe_segment_id, CAST(len(l0) AS INTEGER) AS seq_len, "
    "md5(array_to_string(list_concat(" + ", ".join(
        f"list_transform(l{i}, lambda x: CAST(CAST(ROUND(x * 1000000) AS BIGINT) AS VARCHAR))" for i in range(4))
    + "), ',')) AS seq_md5 FROM ("
    f"SELECT event_id, pipe_segment_id, {_SEQ} FROM fx_slow_leak WINDOW w AS (PARTITION BY pipe_segment_id "
    "ORDER BY event_timestamp, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) t WHERE len(l0) = 20", "fx_slow_leak"))
def e12(spark, sf):
    """All 80 values of every sequence, as a digest in sensor order."""
    s = sequences(fx.slow_leak(spark, sf), SENSORS, 20, label=None)
    def sensor(i):
        return F.transform("seq", lambda x: F.round(x[i] * 1000000).cast("bigint").cast("string"))
    values = F.flatten(F.array(*[sensor(i) for i in range(len(SENSORS))]))
    return s.select(EVENT_ID, SEGMENT, F.size("seq").alias("seq_len"), F.md5(F.concat_ws(",", values)).alias("seq_md5"))


@query("E13_latest_reading", G(
    f"SELECT pipe_segment_id, severity, {R('pressure_psi', 1)} AS pressure_psi, {R('flow_rate_lpm', 1)} AS flow_lpm, "
    f"{R('acoustic_g_rms', 3)} AS acoustic_grms, {R('temperature_c', 1)} AS temp_c, {R('anomaly_score', 4)} AS anomaly_score, "
    "alert_message, event_timestamp FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipe_segment_id "
    "ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM fx_gold) t WHERE rn = 1"))
def e13(spark, sf):
    return reports.latest_reading(gold(spark, sf))


@query("E14_minmax_scale", fx.with_fixtures(
    "SELECT event_id, " + ", ".join(
        R(f"CASE WHEN MAX({c}) OVER () = MIN({c}) OVER () THEN 0.0 ELSE ({c} - MIN({c}) OVER ()) / "
          f"(MAX({c}) OVER () - MIN({c}) OVER ()) END", 6) + f" AS {c}" for c in SENSORS)
    + " FROM fx_slow_leak", "fx_slow_leak"))
def e14(spark, sf):
    s = fx.slow_leak(spark, sf)
    scaled = minmax_scale(s, fit_minmax(s, SENSORS), SENSORS)
    return scaled.select(EVENT_ID, *[rhu(c, 6).alias(c) for c in SENSORS])


# ============================================================== F: sorts, limits
@query("F3_recent", B("SELECT pipe_segment_id, event_timestamp, ingestion_ts, pressure_psi FROM fx_bronze "
                      "ORDER BY ingestion_ts DESC, event_id DESC LIMIT 10"))
def f3(spark, sf):
    return reports.recent(bronze(spark, sf), 10)


@query("F4_critical_audit", G(
    f"SELECT event_timestamp, pipe_segment_id, severity, {R('pressure_psi', 1)} AS pressure_psi, "
    f"{R('pressure_delta', 1)} AS pressure_delta, {R('flow_rate_lpm', 1)} AS flow_lpm, {R('acoustic_g_rms', 3)} AS acoustic_grms, "
    f"{R('anomaly_score', 4)} AS anomaly_score, alert_message FROM fx_gold WHERE {CRIT}"))
def f4(spark, sf):
    return reports.critical_audit(gold(spark, sf))


@query("F5_worst_alerts", G(
    "SELECT event_timestamp, pipe_segment_id, pressure_psi, pressure_delta, anomaly_score, alert_message "
    f"FROM fx_gold WHERE {CRIT} ORDER BY anomaly_score, event_id LIMIT 50"))
def f5(spark, sf):
    return reports.worst_alerts(gold(spark, sf), 50)


@query("F6_explore", G("SELECT * FROM fx_gold ORDER BY pressure_psi DESC, event_id"))
def f6(spark, sf):
    return reports.explore(gold(spark, sf), "pressure_psi", ascending=False)


@query("F7_critical_sample", G(
    "SELECT pipe_segment_id, pressure_psi, pressure_delta, acoustic_zscore, anomaly_score, alert_message "
    f"FROM fx_gold WHERE {CRIT} ORDER BY event_timestamp, event_id LIMIT 5"))
def f7(spark, sf):
    return reports.critical_sample(gold(spark, sf), 5)


@query("F9_anomalies_sorted", G(
    "SELECT pipe_segment_id, pressure_psi, anomaly_score, is_anomaly, event_id FROM fx_gold WHERE anomaly_prediction = -1"))
def f9(spark, sf):
    return reports.anomalies_sorted(gold(spark, sf))


def _place(order: str) -> str:
    return f"ROW_NUMBER() OVER (ORDER BY {order}) AS position"


@query("F1_impact_order", G(
    f"SELECT pipe_segment_id, critical_events, {_place('critical_events DESC, pipe_segment_id')} "
    f"FROM (SELECT pipe_segment_id, {SF(CRIT)} AS critical_events FROM fx_gold GROUP BY pipe_segment_id)"))
def f1(spark, sf):
    out = reports.segment_risk_summary(gold(spark, sf)).select(SEGMENT, "critical_events")
    return reports.positioned(out, F.desc("critical_events"), F.asc(SEGMENT))


@query("F2_severity_order", G(
    "SELECT event_id, severity, " + _place(
        "CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, pipe_segment_id, event_timestamp, event_id")
    + " FROM fx_gold"))
def f2(spark, sf):
    out = gold(spark, sf).select(EVENT_ID, "severity", SEGMENT, EVENT_TS)
    return (reports.positioned(out, reports.severity_rank().asc(), F.asc(SEGMENT), F.asc(EVENT_TS), F.asc(EVENT_ID))
            .select(EVENT_ID, "severity", "position"))


@query("F4_critical_order", G(
    f"SELECT event_id, {R('anomaly_score', 4)} AS anomaly_score, "
    + _place(f"{R('anomaly_score', 4)}, event_timestamp DESC, event_id") + f" FROM fx_gold WHERE {CRIT}"))
def f4_order(spark, sf):
    out = gold(spark, sf).where(CRIT).select(EVENT_ID, EVENT_TS, rhu("anomaly_score", 4).alias("anomaly_score"))
    return (reports.positioned(out, F.asc("anomaly_score"), F.desc(EVENT_TS), F.asc(EVENT_ID))
            .select(EVENT_ID, "anomaly_score", "position"))


@query("F6_explore_order", G(f"SELECT event_id, pressure_psi, {_place('pressure_psi DESC, event_id')} FROM fx_gold"))
def f6_order(spark, sf):
    out = gold(spark, sf).select(EVENT_ID, "pressure_psi")
    return reports.positioned(out, F.desc("pressure_psi"), F.asc(EVENT_ID))


@query("F8_global_sort", S(
    "SELECT event_id, pipe_segment_id, event_timestamp, "
    + _place("pipe_segment_id, event_timestamp, event_id") + " FROM fx_silver"))
def f8(spark, sf):
    return reports.positioned(silver(spark, sf).select(EVENT_ID, SEGMENT, EVENT_TS),
                              F.asc(SEGMENT), F.asc(EVENT_TS), F.asc(EVENT_ID))


@query("F9_anomalies_order", G(
    f"SELECT event_id, anomaly_score, {_place('anomaly_score, event_id')} FROM fx_gold WHERE anomaly_prediction = -1"))
def f9_order(spark, sf):
    out = reports.anomalies_sorted(gold(spark, sf)).select(EVENT_ID, "anomaly_score")
    return reports.positioned(out, F.asc("anomaly_score"), F.asc(EVENT_ID))


# ============================================================== G: set operations
@query("G1_severity_distribution", G(
    f"SELECT 'CRITICAL' AS severity_level, COUNT(*) AS event_count FROM fx_gold WHERE {CRIT} UNION ALL "
    f"SELECT 'WARNING', COUNT(*) FROM fx_gold WHERE {WARN} UNION ALL SELECT 'NORMAL', COUNT(*) FROM fx_gold WHERE {NORM}"))
def g1(spark, sf):
    return reports.severity_distribution(gold(spark, sf))


@query("G2_combine_labelled", fx.with_fixtures(_COMBINED, "fx_silver", "fx_slow_leak"))
def g2(spark, sf):
    return combined(spark, sf)


# ============================================================== H: scalar operators
@query("H1_severity", G("SELECT event_id, anomaly_score, anomaly_prediction, severity FROM fx_gold"))
def h1(spark, sf):
    return gold(spark, sf).select(EVENT_ID, "anomaly_score", "anomaly_prediction", "severity")


@query("H2_alert_message", G("SELECT event_id, severity, alert_message FROM fx_gold"))
def h2(spark, sf):
    return gold(spark, sf).select(EVENT_ID, "severity", "alert_message")


@query("H3_H5_dual_decision", DU(
    "SELECT event_id, if_anomaly, lstm_anomaly, severity, detection_source, alert_message FROM dual"))
def h3(spark, sf):
    return dual(spark, sf).select(EVENT_ID, "if_anomaly", "lstm_anomaly", "severity",
                                  "detection_source", "alert_message")


@query("H6_binary_label", B(
    "SELECT event_id, CASE WHEN is_anomaly <> 'normal' THEN 1 ELSE 0 END AS label_any, "
    "CASE WHEN is_anomaly = 'leak' THEN 1 ELSE 0 END AS label_leak FROM fx_bronze"))
def h6(spark, sf):
    b = bronze(spark, sf)
    return b.select(EVENT_ID, binary_label_expr("is_anomaly").alias("label_any"),
                    binary_label_expr("is_anomaly", positive="leak").alias("label_leak"))


# ============================================================== J: model operators
_HASH = "CAST('0x' || substr(md5(concat_ws(':', {0})), 1, 13) AS BIGINT)"


@query("J1_stratified_split", S(
    "WITH l AS (SELECT event_id, CASE WHEN is_anomaly = 'leak' THEN 1 ELSE 0 END AS label FROM fx_silver), "
    f"r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_HASH.format("'42', event_id")}, event_id) AS i, "
    "COUNT(*) OVER (PARTITION BY label) AS n FROM l) "
    "SELECT event_id, label, CASE WHEN i <= CEIL(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r"))
def j1(spark, sf):
    s = silver(spark, sf).withColumn("label", binary_label_expr("is_anomaly", positive="leak"))
    s = as_table(s.select(EVENT_ID, "label"), "labelled")  # read for the edges and for the split
    return stratified_split(s, "label", 0.2, 42, rows_per_cell=200).select(EVENT_ID, "label", "split")


@query("J1_positional_split", fx.with_fixtures(
    "WITH r AS (SELECT event_id, ROW_NUMBER() OVER (ORDER BY pipe_segment_id, event_timestamp, event_id) AS i, "
    "COUNT(*) OVER () AS n FROM fx_slow_leak) "
    "SELECT event_id, CASE WHEN i <= FLOOR(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM r", "fx_slow_leak"))
def j1_positional(spark, sf):
    return positional_split(fx.slow_leak(spark, sf), 0.8, target_rows=500).select(EVENT_ID, "split")


_P = "(3.0 * 256 / (SELECT COUNT(*) FROM fx_silver))"


@query("J3_tree_samples", S(
    "WITH t AS (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS tree), "
    f"f AS (SELECT event_id, CAST(FLOOR(LN(1 - {_HASH.format("'7', 'first', event_id")} / 4503599627370496.0) / "
    f"LN(1 - {_P})) AS BIGINT) AS first FROM fx_silver), "
    "c AS (SELECT f.event_id, t.tree FROM f JOIN t ON t.tree >= f.first "
    f"WHERE t.tree = f.first OR {_HASH.format("'7', 'next', CAST(t.tree AS VARCHAR), f.event_id")} < {_P} * 4503599627370496.0), "
    f"r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY "
    f"{_HASH.format("'7', CAST(tree AS VARCHAR), event_id")}, event_id) AS i FROM c) "
    "SELECT tree, event_id FROM r WHERE i <= 256"))
def j3_samples(spark, sf):
    sample, _ = tree_samples(silver(spark, sf), ["pressure_psi"], 8, 256, 7)
    return sample.select("tree", EVENT_ID)


@query("J2_standardise", S(
    "SELECT event_id, " + ", ".join(
        R(f"({c} - AVG({c}) OVER ()) / CASE WHEN STDDEV_POP({c}) OVER () = 0 THEN 1.0 ELSE STDDEV_POP({c}) OVER () END", 6)
        + f" AS {c}" for c in FOREST_FEATURES) + " FROM fx_silver"))
def j2(spark, sf):
    s = as_table(silver(spark, sf).select(EVENT_ID, *FOREST_FEATURES), "features")  # read for the scaler and scaled
    z = standardise(s, fit_standard_scaler(s, FOREST_FEATURES), FOREST_FEATURES)
    return z.select(EVENT_ID, *[rhu(c, 6).alias(c) for c in FOREST_FEATURES])


@query("J4_contamination_offset", G(
    f"SELECT {R('QUANTILE_CONT(anomaly_score, 0.08)', 6)} AS quantile FROM fx_gold"))
def j4(spark, sf):
    q = exact_quantile(gold(spark, sf), "anomaly_score", 0.08)
    return q.select(rhu("quantile", 6).alias("quantile"))


@query("J4_offset_narrowed_band", G(
    f"SELECT {R('QUANTILE_CONT(anomaly_score, 0.08)', 6)} AS quantile FROM fx_gold"))
def j4_band(spark, sf):
    """J4 with a band limit far below the input: the narrowing path."""
    q = exact_quantile(gold(spark, sf), "anomaly_score", 0.08, band_limit=500, accuracy=200)
    return q.select(rhu("quantile", 6).alias("quantile"))


@query("J7_calibrate", G(
    f"SELECT {R('QUANTILE_CONT(anomaly_score, 0.5)', 6)} AS suggested_cut FROM fx_gold WHERE anomaly_prediction = -1"))
def j7(spark, sf):
    return calibrate(gold(spark, sf)).select(rhu("suggested_cut", 6).alias("suggested_cut"))


def queries() -> dict[str, Builder]:
    from leakscope.plans import model_queries  # noqa: F401  (registers model entries)
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    from leakscope.plans import model_queries  # noqa: F401
    return dict(ORACLES)
