"""Test inputs derived from the driver's ``events`` table by SQL.

The reference ships no data; its generators are not rebuilt. These SQL texts
derive the same row shapes deterministically from ``events`` and evaluate to
the same cells in Spark and DuckDB. They are test data only: the operators in
``leakscope.operators`` never depend on them.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Readings from real columns of ``events``: the segment from user_id, the time
# from ts, the sensors from value (in hundredths) and from the number in props,
# scaled so that large values leave the sensor bounds; large values are leaks.
FX_BRONZE_SQL = """
WITH r AS (SELECT event_id, user_id, ts, event_type, CAST(ROUND(value * 100) AS BIGINT) AS v,
                  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
SELECT CAST(event_id AS STRING) AS event_id,
       CONCAT('PIPE-00', CAST(user_id % 5 + 1 AS STRING)) AS pipe_segment_id,
       ts AS event_timestamp,
       CASE WHEN event_type = 'error' AND k = 7 THEN NULL ELSE (100000 - 2 * v + 10 * k) / 100.0E0 END AS pressure_psi,
       (15000 + 100 * k + v) / 100.0E0 AS flow_rate_lpm,
       (1000 + 50 * CAST(FLOOR(v / 100) AS BIGINT) + 10 * k) / 10000.0E0 AS acoustic_g_rms,
       (3000 + 20 * k - CAST(FLOOR(v / 8) AS BIGINT)) / 100.0E0 AS temperature_c,
       CASE WHEN v >= 13000 THEN 'leak' ELSE 'normal' END AS is_anomaly,
       ts AS ingestion_ts
FROM r
"""

_ROLL = "OVER (PARTITION BY pipe_segment_id ORDER BY event_timestamp, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
_LAG = "OVER (PARTITION BY pipe_segment_id ORDER BY event_timestamp, event_id)"

FX_SILVER_SQL = f"""
WITH b AS (SELECT * FROM fx_bronze), q AS (
 SELECT * FROM b WHERE pressure_psi BETWEEN 100.0 AND 3000.0 AND flow_rate_lpm BETWEEN 0.0 AND 600.0
   AND acoustic_g_rms BETWEEN 0.0 AND 10.0 AND temperature_c BETWEEN -20.0 AND 200.0),
f AS (SELECT q.*,
  CAST(ROUND(CAST(AVG(pressure_psi) {_ROLL} AS DECIMAL(38,8)), 2) AS DOUBLE) AS pressure_rolling_avg,
  CAST(ROUND(CAST(AVG(flow_rate_lpm) {_ROLL} AS DECIMAL(38,8)), 2) AS DOUBLE) AS flow_rolling_avg,
  CAST(ROUND(CAST(AVG(acoustic_g_rms) {_ROLL} AS DECIMAL(38,8)), 4) AS DOUBLE) AS acoustic_rolling_avg,
  CAST(ROUND(CAST(pressure_psi - LAG(pressure_psi,1) {_LAG} AS DECIMAL(38,8)), 2) AS DOUBLE) AS pressure_delta,
  CAST(ROUND(CAST(STDDEV_SAMP(acoustic_g_rms) {_ROLL} AS DECIMAL(38,8)), 4) AS DOUBLE) AS acoustic_rolling_std FROM q),
g AS (SELECT f.*, CAST(ROUND(CAST(flow_rate_lpm / flow_rolling_avg AS DECIMAL(38,8)), 4) AS DOUBLE) AS flow_imbalance_ratio,
  CAST(ROUND(CAST((acoustic_g_rms - acoustic_rolling_avg) / (acoustic_rolling_std + 0.0001E0) AS DECIMAL(38,8)), 4) AS DOUBLE) AS acoustic_zscore FROM f)
SELECT * FROM g WHERE pressure_delta IS NOT NULL AND acoustic_rolling_std IS NOT NULL
"""

# Closed-form stand-in for the model score, so dashboards have an exact oracle.
STANDIN_SCORE_SQL = ("CAST(CAST(30 - CASE WHEN pressure_psi < 850 THEN 45 ELSE 0 END "
                     "- CASE WHEN acoustic_g_rms > 1.0 THEN 30 ELSE 0 END "
                     "- CASE WHEN flow_rate_lpm > 250 THEN 20 ELSE 0 END "
                     "- CAST(event_id AS BIGINT) % 29 AS DECIMAL(18,4)) / 1000 AS DOUBLE)")

# Alert text of the triggers, shared by the Gold and dual-model SQL.
TRIGGER_TEXTS = (
    "CASE WHEN pressure_delta < -100 THEN CONCAT('Pressure drop ', CAST(CAST(ROUND(CAST(pressure_delta AS DECIMAL(18,2)),0) AS BIGINT) AS STRING), ' PSI') END, "
    "CASE WHEN flow_imbalance_ratio > 1.25E0 THEN CONCAT('Flow spike x', CAST(CAST(ROUND(CAST(flow_imbalance_ratio AS DECIMAL(18,4)),2) AS DECIMAL(18,2)) AS STRING)) END, "
    "CASE WHEN ABS(acoustic_zscore) > 2.0E0 THEN CONCAT('Acoustic anomaly z=', CAST(CAST(ROUND(CAST(acoustic_zscore AS DECIMAL(18,4)),2) AS DECIMAL(18,2)) AS STRING)) END")

# Severity and alert text of rows ``sc`` that have a score.
CLASSIFY_SQL = f"""s2 AS (SELECT sc.*, CASE WHEN anomaly_score < 0 THEN -1 ELSE 1 END AS anomaly_prediction FROM sc),
s3 AS (SELECT s2.*, CASE WHEN anomaly_prediction = 1 THEN 'NORMAL' WHEN anomaly_score <= -0.07E0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM s2)
SELECT s3.*, CASE WHEN severity = 'NORMAL' THEN ''
  WHEN pressure_delta < -100 OR flow_imbalance_ratio > 1.25E0 OR ABS(acoustic_zscore) > 2.0E0 THEN CONCAT_WS('; ',
   {TRIGGER_TEXTS})
  ELSE 'Multi-sensor anomaly' END AS alert_message FROM s3
"""

FX_GOLD_SQL = f"""
WITH sv AS (SELECT * FROM fx_silver), sc AS (SELECT sv.*, {STANDIN_SCORE_SQL} AS anomaly_score FROM sv),
{CLASSIFY_SQL}"""

# Readings that drift: a step taken from the id (no rank) moves the sensors away
# from the real reading, and the last third of the steps is labelled.
FX_SLOW_LEAK_SQL = """
WITH n AS (SELECT b.*, CAST(event_id AS BIGINT) % 36 AS step FROM fx_bronze b)
SELECT event_id, pipe_segment_id, event_timestamp,
 COALESCE(pressure_psi, 900.0E0) - 4 * step AS pressure_psi,
 flow_rate_lpm + 2 * step AS flow_rate_lpm, acoustic_g_rms + step / 64.0E0 AS acoustic_g_rms,
 temperature_c - step / 8.0E0 AS temperature_c,
 CASE WHEN step >= 24 THEN 'slow_leak' ELSE 'normal' END AS is_anomaly,
 CONCAT(pipe_segment_id, '_seq_', CAST(step AS STRING)) AS sequence_id FROM n
"""

# Dual-model flags on top of fx_gold (FIXTURES §6).
FX_DUAL_FLAGS_SQL = ("CASE WHEN anomaly_prediction = -1 THEN 1 ELSE 0 END",
                     "CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END")

_CTE_ORDER = ["fx_bronze", "fx_silver", "fx_gold", "fx_slow_leak"]
_CTE_SQL = {"fx_bronze": FX_BRONZE_SQL, "fx_silver": FX_SILVER_SQL,
            "fx_gold": FX_GOLD_SQL, "fx_slow_leak": FX_SLOW_LEAK_SQL}
_CTE_DEPS = {"fx_bronze": [], "fx_silver": ["fx_bronze"], "fx_gold": ["fx_silver"],
             "fx_slow_leak": ["fx_bronze"]}


def with_fixtures(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (oracle SQL for DuckDB)."""
    need: set[str] = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _CTE_DEPS[n]:
                add(d)
    for n in names:
        add(n)
    parts = [f"{n} AS ({_CTE_SQL[n]})" for n in _CTE_ORDER if n in need]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    if not parts:
        return body
    if body.lstrip().upper().startswith("WITH "):  # merge the body's own CTEs
        return "WITH " + ",\n".join(parts) + ",\n" + body.lstrip()[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_bronze as a Spark DataFrame (a projection over ``events``)."""
    return spark.sql(FX_BRONZE_SQL.replace("FROM events", "FROM {events}"),
                     events=table(spark, sf_dir, "events"))


def bronze_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze`` for readers of all sensors that filter on them. A filter on
    sensors moves below the projection and takes the expressions of v and k
    with it, once for each mention: some 30 searches in props a row. Behind
    ``inline`` they are columns, worked out once a row."""
    parts, readings = FX_BRONZE_SQL.split("FROM events)")
    names, v, k = re.search(r"SELECT (.*?), (CAST\(ROUND.*?) AS v,\s*(CAST\(regexp.*?) AS k\s*$", parts, re.S).groups()
    r = table(spark, sf_dir, "events").select(*names.split(", "), F.inline(F.array(F.struct(
        F.expr(v).alias("v"), F.expr(k).alias("k")))))
    return spark.sql(readings.replace("FROM r", "FROM {r}"), r=r)


def slow_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_slow_leak: drifting cycles of 50 readings per segment."""
    sql = FX_SLOW_LEAK_SQL.replace("FROM fx_bronze", "FROM {fx_bronze}")
    return spark.sql(sql, fx_bronze=bronze_parsed(spark, sf_dir))


def standin_score() -> Column:
    """The score of ``STANDIN_SCORE_SQL``, thousandths from -123 to 58 divided
    in doubles: the double nearest to the quotient, as the decimal's is. Spark
    works the score out once for each mention in a filter, and a decimal
    division there costs more than the rest of Gold."""
    thousandths = re.fullmatch(r"CAST\(CAST\((.*) AS DECIMAL\(18,4\)\) / 1000 AS DOUBLE\)", STANDIN_SCORE_SQL)[1]
    return F.expr(f"({thousandths}) / 1000.0E0")


def dual_flags(gold: DataFrame) -> DataFrame:
    """Adds if_anomaly / lstm_anomaly fixture flags to a Gold frame."""
    return (gold.withColumn("if_anomaly", F.expr(FX_DUAL_FLAGS_SQL[0]).cast("int"))
            .withColumn("lstm_anomaly", F.expr(FX_DUAL_FLAGS_SQL[1]).cast("int")))
