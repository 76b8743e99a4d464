"""How often the medallion queries read and compute their rows."""

import dataclasses
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.operators import reports, selection
from leakscope.operators.selection import exact_quantile
from leakscope.operators.windowing import epoch_micros, with_bucket, with_halo
from leakscope.plans import medallion as M
from leakscope.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_silver_parses_and_filters_bronze_once(spark):
    """Plan, counts, halos and windows read the filtered rows as written."""
    assert "regexp_extract" not in _plan(M.fixture_silver(spark, SF_SMALL))


def test_sorts_read_written_rows(spark):
    """A range sort runs its input twice, so the windows stand before a table."""
    g = M.fixture_gold(spark, SF_SMALL)
    assert "Window" in _plan(g)
    for out in (reports.explore(g, "pressure_psi"), reports.critical_audit(g), reports.anomalies_sorted(g)):
        assert "Window" not in _plan(out)


def test_one_key_of_some_rows_is_many_buckets(spark):
    df = spark.range(400_000).select(F.col("id").cast("string").alias("event_id"), F.lit("S").alias("seg"),
                                     F.expr("timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"))
    sizes = [r["count"] for r in with_bucket(df, "seg", "ts", "event_id").groupBy("_b").count().collect()]
    assert len(sizes) >= 3 and max(sizes) <= 200_000


def test_epoch_micros_of_wall_clocks(spark):
    times = [dt.datetime(1, 1, 1, 0, 0, 0, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), dt.datetime(2024, 3, 10, 2, 30, 0, 500_000),
             dt.datetime(9999, 12, 31, 23, 59, 59, 999_999), None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    want = [None if t is None else (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times]
    assert [r[0] for r in df.select(epoch_micros(df, "ts")).collect()] == want


@pytest.mark.parametrize("distinct", [3, 120, 5000])
def test_quantile_takes_few_passes(spark, monkeypatch, distinct):
    passes, sketch = [], F.percentile_approx
    monkeypatch.setattr(selection.F, "percentile_approx", lambda *a: passes.append(1) or sketch(*a))
    vals = np.random.default_rng(5).integers(0, distinct, 20_000) / 8
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    assert exact_quantile(df, "v", 0.08, band_limit=20, accuracy=200).first()[0] == pytest.approx(np.quantile(vals, 0.08), abs=1e-12)
    assert len(passes) <= 3


@pytest.mark.parametrize("vals", [[], [None, float("nan")], [2.0], [None, 1.0, float("nan"), -0.0, 0.0, 4.0]])
def test_quantile_of_few_null_and_nan_rows(spark, vals):
    kept = [v for v in vals if v is not None and v == v]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = exact_quantile(df, "v", 0.5, band_limit=1, accuracy=100).first()[0]
    assert got == (float(np.quantile(kept, 0.5)) if kept else None)


@pytest.mark.parametrize("critical", [False, True])
def test_generated_methods_are_small_enough_for_the_jvm(spark, critical):
    """The JVM does not compile a method of over 8000 bytes."""
    g = M.fixture_gold(spark, SF_SMALL)
    g = g.where("severity = 'CRITICAL'") if critical else g
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no generated code before it runs
    try:
        made = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(g.select("*")._jdf.queryExecution().debug().codegenToSeq())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert made and max(m._3().maxMethodCodeSize() for m in made) < 8000


def test_halos_sort_only_the_rows_near_the_ends_of_buckets(spark):
    """The rank from a bucket's end is taken after its last slices are picked."""
    df = spark.range(400_000).select(F.col("id").cast("string").alias("event_id"), F.lit("S").alias("seg"),
                                     F.expr("timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"))
    frame = with_halo(df, "seg", ["ts", "event_id"], "ts", 9)
    ranked = [line for line in _plan(frame).splitlines() if "_slice" in line and ">=" in line]
    assert ranked  # a filter on the slices stands below the window
    assert frame.where("_halo").count() == 9 * (frame.select("_chunk").distinct().count() - 1)


def test_roundings_are_mostly_worked_out_in_doubles(spark):
    """The decimal of both rules agree, on ties, beside them, below zero and on large values."""
    from leakscope.functions.rounding import round_half_up
    rng = np.random.default_rng(7)
    ties = rng.integers(-10 ** 6, 10 ** 6, 4000) / 2 ** rng.integers(0, 12, 4000)
    near = np.round(rng.uniform(-300, 300, 4000), 2) + rng.choice([0, .005, .00005, 4.9e-9, 5e-9, 5.1e-9, .004999995, .0049999949], 4000)
    vals = [*ties, *near, *rng.normal(0, 1e-4, 2000), *rng.normal(0, 1e7, 500), 0.0, -0.0, -0.001, 0.285, 1.005, None, float("nan"), float("inf"), 1e300]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "v double")
    for n in (0, 1, 2, 4, 6, 8):
        plain = F.when(F.abs("v") < 1e16, F.round(F.col("v").cast("decimal(38,8)"), n).cast("double")).otherwise(F.col("v"))
        pairs = df.select(F.hex(F.col("v").cast("string").cast("binary")), round_half_up("v", n).cast("string").alias("a"), plain.cast("string").alias("b"))
        assert pairs.where("NOT a <=> b").collect() == []
    shown = df.select(round_half_up("v", 2))._jdf.queryExecution().executedPlan().toString()
    assert "transform" in shown  # the decimal's part does not enter a whole stage's method


def test_every_row_goes_down_the_trees_once(spark, monkeypatch):
    from leakscope.operators import forest
    scored, whole = [], forest._score_udf
    monkeypatch.setattr(forest, "_score_udf", lambda m: scored.append(1) or whole(m))
    silver = M.fixture_silver(spark, SF_SMALL)
    gold, model = M.model_gold(silver, trees=10, psi=32)
    assert gold.count() == silver.count() and len(scored) == 1
    monkeypatch.undo()
    again, _ = forest.fit_pipeline(silver, trees=10, psi=32)
    assert again.offset == model.offset


def test_sequences_are_made_for_the_rows_that_are_used(spark, monkeypatch):
    """Only the fit's rows are written as vectors, and the test rows are all rows after the border."""
    from leakscope.operators import sequence
    written, table = {}, sequence.as_table
    def as_table(df, name):
        written[name] = table(df, name)
        return written[name]
    monkeypatch.setattr(sequence, "as_table", as_table)
    rows = [(f"e{i:04d}", f"S{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), *(float((i * k) % 17) for k in (1, 2, 3, 5)), int(i % 5 == 0))
            for i in range(900)]
    df = spark.createDataFrame(rows, "event_id string, pipe_segment_id string, event_timestamp timestamp_ntz, " +
                               ", ".join(f"{c} double" for c in sequence.SEQUENCE_FEATURES) + ", label int")
    _, test = sequence.fit_sequence_model(df, max_iter=2, max_fit_rows=200)
    order = sorted((r for r in rows if int(r[0][1:]) // 3 >= 20), key=lambda r: (r[1], r[2]))
    k = int(0.8 * len(order))
    assert {r.event_id for r in test.collect()} == {r[0] for r in order[k:]}
    fitted = {r.event_id for r in written["sequences"].collect()}
    assert 100 < len(fitted) < 300 and fitted <= {r[0] for r in order[:k]}


def test_gold_score_is_worked_out_in_doubles_and_equals_the_sql(spark):
    rows = [(str(i), p, a, f) for i in range(-29, 30) for p in (849.9, 850.0) for a in (1.0, 1.1) for f in (250.0, 250.1)]
    df = spark.createDataFrame(rows, "event_id string, pressure_psi double, acoustic_g_rms double, flow_rate_lpm double")
    both = df.select(fx.standin_score().alias("a"), F.expr(fx.STANDIN_SCORE_SQL).alias("b"))
    assert both.count() == len(rows) and both.where("NOT (a <=> b) OR a IS NULL").count() == 0
    plan = df.select("event_id", fx.standin_score().alias("a")).where("a < -0.07")._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan


def _frame_of_the_fit(spark, monkeypatch, query, events):
    """(frame that the sequence model is fitted on, train rows), where the border counts far more train rows than there are."""
    from leakscope.operators import sequence
    from leakscope.plans import catalog, model_queries  # noqa: F401

    class Seen(Exception):
        pass
    seen, whole = {}, sequence.train_border
    def train_border(*a, **k):
        border = whole(*a, **k)
        seen["rows"] = border.train_rows
        return dataclasses.replace(border, train_rows=10 ** 9)
    def fit(self, df, *a):
        seen["frame"] = df
        raise Seen
    monkeypatch.setattr(sequence, "train_border", train_border)
    monkeypatch.setattr(sequence.MultilayerPerceptronClassifier, "fit", fit)
    with pytest.raises(Seen):
        catalog.queries()[query](spark, events)
    return seen["frame"], seen["rows"]


@pytest.fixture()
def own_events(spark, tmpdir_run):
    """600 events of five segments, as a table folder."""
    (spark.range(600).select(
        F.col("id").alias("event_id"), F.expr("timestampadd(SECOND, id * 7, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("ts"),
        F.col("id").alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") * 37 % 190 + F.lit(0.25)).alias("value"),
        F.format_string('{"k": %d}', F.col("id") * 13 % 100).alias("props")).write.parquet(f"{tmpdir_run}/events.parquet"))
    return tmpdir_run


def test_dual_gold_fits_its_sequence_model_on_all_train_rows(spark, monkeypatch, own_events):
    frame, rows = _frame_of_the_fit(spark, monkeypatch, "J6_dual_gold", own_events)
    assert rows > 700 and frame.select("event_id").distinct().count() == frame.count() == rows


def test_sequence_classifier_is_fitted_on_all_train_rows(spark, monkeypatch, own_events):
    frame, rows = _frame_of_the_fit(spark, monkeypatch, "J8_sequence_model", own_events)
    assert rows > 700 and frame.select("event_id").distinct().count() == frame.count() == rows
    assert set(r.split for r in frame.select("split").distinct().collect()) == {"train"}
