"""Edge cases of FIXTURES §7 and operator semantics on unit rows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.functions.severity import alert_message_expr, severity_expr
from leakscope.operators import metrics, reports
from leakscope.operators.features import batch_features, microbatch_features
from leakscope.operators.quality import quality_filter, quality_report
from leakscope.operators.selection import exact_quantile, smallest_per_group
from leakscope.schemas import BRONZE_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def _bronze(spark, rows):
    full = [(r[0], r[1], T0 + dt.timedelta(minutes=r[2]), r[3], r[4], r[5], r[6], r[7],
             T0) for r in rows]
    return spark.createDataFrame(full, BRONZE_SCHEMA)


def test_quality_bounds_nan_null(spark):
    rows = [("a", "S", 0, 100.0, 0.0, 0.0, -20.0, "normal"),      # on bounds: kept
            ("b", "S", 1, 3000.0, 600.0, 10.0, 200.0, "normal"),  # on bounds: kept
            ("c", "S", 2, float("nan"), 1.0, 1.0, 1.0, "normal"),  # NaN: dropped
            ("d", "S", 3, None, 1.0, 1.0, 1.0, "normal"),          # NULL: dropped
            ("e", "S", 4, 99.99, 1.0, 1.0, 1.0, "normal")]          # out of bound
    df = _bronze(spark, rows)
    assert sorted(r.event_id for r in quality_filter(df).collect()) == ["a", "b"]
    r = quality_report(df).first()
    assert (r.before_count, r.after_count, r.dropped_count) == (5, 2, 3)


def test_single_reading_segment_dropped_and_ties(spark):
    rows = [("x1", "ONE", 0, 1000.0, 200.0, 0.3, 45.0, "normal")] + \
           [(f"t{i}", "TIE", 5, 1000.0 + i, 200.0, 0.3 + i / 10, 45.0, "normal") for i in range(4)]
    out = batch_features(_bronze(spark, rows)).toPandas()
    assert "x1" not in set(out.event_id)           # no delta, no std
    assert sorted(out.event_id) == ["t1", "t2", "t3"]  # ties ordered by event_id
    assert out.set_index("event_id").loc["t1", "pressure_delta"] == 1.0


def test_microbatch_constant_acoustic_gives_zero_z(spark):
    rows = [(f"c{i}", "S", i, 1000.0, 200.0, 0.5, 45.0, "normal") for i in range(5)]
    out = microbatch_features(_bronze(spark, rows), with_clock=False).toPandas()
    assert len(out) == 4 and (out.acoustic_zscore == 0.0).all()


def test_severity_and_message_thresholds(spark):
    rows = [(-0.07, -100.0, 1.25, 2.0), (-0.0700001, -100.6, 1.251, -2.0001), (0.0, -500.0, 2.0, 3.0),
            (-0.01, None, None, None), (-0.5, -100.5, 1.3, 2.5)]
    df = spark.createDataFrame(rows, "anomaly_score double, pressure_delta double, "
                                     "flow_imbalance_ratio double, acoustic_zscore double")
    df = df.withColumn("anomaly_prediction", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))
    out = df.withColumn("severity", severity_expr()).withColumn("alert_message", alert_message_expr())
    got = [(r.severity, r.alert_message) for r in out.collect()]
    assert got[0] == ("CRITICAL", "Multi-sensor anomaly")
    assert got[1] == ("CRITICAL", "Pressure drop -101 PSI; Flow spike x1.25; Acoustic anomaly z=-2.00")
    assert got[2] == ("NORMAL", "")
    assert got[3] == ("WARNING", "Multi-sensor anomaly")
    assert got[4][1] == "Pressure drop -101 PSI; Flow spike x1.30; Acoustic anomaly z=2.50"


def _gold(spark, rows):
    return spark.createDataFrame(rows, "event_id string, pipe_segment_id string, event_timestamp timestamp_ntz, "
                                       "pressure_psi double, severity string, anomaly_score double, "
                                       "alert_message string, acoustic_g_rms double, flow_rate_lpm double")


def test_empty_kpi_and_distribution(spark):
    g = _gold(spark, [])
    k = reports.kpi(g).first()
    assert k.critical_events is None and k.segments_monitored == 0
    dist = {r.severity_level: r.event_count for r in reports.severity_distribution(g).collect()}
    assert dist == {"CRITICAL": 0, "WARNING": 0, "NORMAL": 0}
    assert reports.critical_digest(g).count() == 0


def test_absent_severity_zero_and_mode_ties(spark):
    rows = [("1", "A", T0, 900.0, "CRITICAL", -0.2, "m1", 1.0, 200.0),
            ("2", "A", T0, 950.0, "NORMAL", 0.1, "", 0.3, 210.0),
            ("3", "B", T0, 990.0, "NORMAL", 0.1, "", 0.3, 210.0)]
    g = _gold(spark, rows)
    dist = {r.severity_level: r.event_count for r in reports.severity_distribution(g).collect()}
    assert dist["WARNING"] == 0
    g2 = g.withColumn("temperature_c", F.lit(40.0))
    det = {r.pipe_segment_id: r.severity for r in reports.segment_details(g2).collect()}
    assert det["A"] == "CRITICAL"  # tie CRITICAL/NORMAL -> smallest


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rows = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["1"].precision == 0.0 and rows["1"].recall == 0.0 and rows["1"].support == 1
    assert math.isclose(rows["accuracy"].f1_score, 2 / 3, rel_tol=1e-6)


@pytest.mark.parametrize("q", [0.0, 0.08, 0.5, 0.93, 1.0])
def test_exact_quantile_band_path_matches_numpy(spark, q):
    rng = np.random.default_rng(7)
    vals = np.round(rng.normal(size=3000), 3)  # ties on purpose
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = exact_quantile(df, "v", q).first()[0]
    got_small_band = exact_quantile(df, "v", q, band_limit=100, accuracy=200).first()[0]
    want = float(np.quantile(vals, q))
    assert math.isclose(got, want, abs_tol=1e-12)
    assert math.isclose(got_small_band, want, abs_tol=1e-12)


@pytest.mark.parametrize("per_cell", [3, 50, 100_000])
def test_smallest_per_group_with_ties_and_many_groups(spark, per_cell):
    rows = [(g, (i * i * 7919 % 97) << 40, f"k{i:03d}") for g in [None, *range(130)] for i in range(9 + (g or 0) % 5)]
    df = spark.createDataFrame(rows, "g long, h long, id string")
    got = {r["g"]: (r["edge"]["v"], r["edge"]["k"]) for r in smallest_per_group(df, "g", "h", "id", 0.3, per_cell).collect()}
    for g in {r[0] for r in rows}:
        own = sorted(x[1:] for x in rows if x[0] == g)
        assert got[g] == own[math.ceil(0.3 * len(own)) - 1]


def _py_message(sev, d, r, z):
    """Plain-Python statement of the alert text rule (half-up decimals)."""
    from decimal import ROUND_HALF_UP, Decimal
    if sev == "NORMAL":
        return ""
    parts = []
    if d is not None and d < -100:
        parts.append(f"Pressure drop {Decimal(str(d)).quantize(Decimal('1'), ROUND_HALF_UP)} PSI")
    if r is not None and r > 1.25:
        parts.append(f"Flow spike x{Decimal(str(r)).quantize(Decimal('0.01'), ROUND_HALF_UP)}")
    if z is not None and abs(z) > 2.0:
        parts.append(f"Acoustic anomaly z={Decimal(str(z)).quantize(Decimal('0.01'), ROUND_HALF_UP)}")
    return "; ".join(parts) if parts else "Multi-sensor anomaly"


def test_alert_message_matches_python_rule_on_random_rows(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(600):
        sev = str(rng.choice(["NORMAL", "WARNING", "CRITICAL"]))
        d = None if rng.random() < 0.1 else round(float(rng.uniform(-400, 50)), 2)
        r = None if rng.random() < 0.1 else round(float(rng.uniform(0.5, 2.0)), 4)
        z = None if rng.random() < 0.1 else round(float(rng.uniform(-5, 5)), 4)
        rows.append((sev, d, r, z))
    df = spark.createDataFrame(rows, "severity string, pressure_delta double, "
                                     "flow_imbalance_ratio double, acoustic_zscore double")
    got = [r.m for r in df.select(alert_message_expr().alias("m")).collect()]
    want = [_py_message(*row) for row in rows]
    assert got == want


@pytest.mark.parametrize("vals,q", [([1.0] * 2000 + [2.0] * 10 + [0.5] * 10, 0.5),
                                    ([1.0] * 1000 + [2.0] * 1000, 0.5), ([3.0] * 700 + [1.0] * 900, 0.1)])
def test_exact_quantile_heavy_ties_without_ranking_rows(spark, vals, q):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = exact_quantile(df, "v", q, band_limit=50, accuracy=100)
    assert out.first()[0] == float(np.quantile(vals, q))
    # the one global window runs over distinct values, below which rows are aggregated
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.rindex("Aggregate")


def test_rounding_of_large_sums(spark):
    from leakscope.functions.rounding import round_half_up
    vals = [2e10 + 0.125, 1e12, 1.23456e15, 3e17, 1e300, None, -4e12 - 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(round_half_up("v", 2)).collect()] == [
        2e10 + 0.13, 1e12, 1.23456e15, 3e17, 1e300, None, -4e12 - 0.5]


def test_round_half_up_matches_decimal_rule(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from leakscope.functions.rounding import round_half_up

    values = []

    @settings(max_examples=400, derandomize=True)
    @given(st.floats(min_value=-5000, max_value=5000, allow_nan=False, allow_infinity=False),
           st.integers(min_value=0, max_value=4))
    def collect(x, n):
        values.append((x, n))
    collect()
    df = spark.createDataFrame(values, "x double, n int")
    got = [r.r for r in df.select(
        *[round_half_up(F.when(F.col("n") == k, F.col("x")), k).alias(f"r{k}") for k in range(5)])
        .select(F.coalesce(*[F.col(f"r{k}") for k in range(5)]).alias("r")).collect()]

    def rule(x, n):
        eight = Decimal(repr(x)).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        return float(eight.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))
    assert got == [rule(x, n) for x, n in values]
