"""Reorder buffer, corrections and model refresh: Silver and Gold equal the
batch tables for every cap, order of arrival and delay."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leakscope.operators import registry
from leakscope.operators.features import batch_features
from leakscope.operators.forest import fit_pipeline, score_forest
from leakscope.operators.gold import classify, gold_table
from leakscope.operators.quality import quality_filter
from leakscope.schemas import BATCH_FEATURES
from leakscope.sources import fixtures as fx
from leakscope.streaming import ordered as O

from tests.conftest import SF_SMALL

GOLD = ["event_id", "anomaly_score", "severity", "alert_message"]


@pytest.fixture(scope="module")
def bronze(spark):
    return fx.bronze(spark, SF_SMALL).limit(1500).cache()


@pytest.fixture(scope="module")
def model(spark, bronze):
    return fit_pipeline(batch_features(quality_filter(bronze)), trees=10, psi=64)[0]


def _frame(df, cols):
    return df.select(cols).toPandas().sort_values(cols).reset_index(drop=True)


def _files(bronze, path, k, order):
    """``bronze`` in k files of one time range each, arriving in ``order``; every
    file also holds a few rows of the other ranges."""
    pdf = bronze.toPandas().sort_values(["event_timestamp", "event_id"]).reset_index(drop=True)
    part = (pdf.index * k // len(pdf)).to_numpy().copy()
    part[::17] = (part[::17] + 1) % k
    os.makedirs(path)
    for at, j in enumerate(order):
        rows = bronze.sparkSession.createDataFrame(pdf[part == j], bronze.schema)
        tmp = f"{path}-{at}"
        rows.coalesce(1).write.parquet(tmp)
        name = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
        os.rename(os.path.join(tmp, name), os.path.join(path, f"{at}.parquet"))
        os.utime(os.path.join(path, f"{at}.parquet"), (1_700_000_000 + at,) * 2)


@pytest.mark.parametrize("cap,order,delay", [
    (1, [2, 0, 3, 1], "1 hour"), (3, [3, 1, 0, 2], 0), (None, [1, 0, 3, 2], "2 days")])
def test_gold_equals_batch_gold(spark, bronze, model, tmpdir_run, cap, order, delay):
    src, silver, gold = (os.path.join(tmpdir_run, x) for x in ("bronze", "silver", "gold"))
    _files(bronze, src, 4, order)
    O.run_silver_ordered(spark, src, silver, os.path.join(tmpdir_run, "ck"), bronze.schema, delay, max_files=cap)
    want = batch_features(quality_filter(bronze))
    cols = ["event_id", *BATCH_FEATURES]
    pd.testing.assert_frame_equal(_frame(O.silver_now(spark, silver, bronze.schema), cols), _frame(want, cols))
    O.run_gold_ordered(spark, silver, gold, os.path.join(tmpdir_run, "ckg"), bronze.schema, model)
    wanted = gold_table(classify(score_forest(want, model)), with_clock=False)
    pd.testing.assert_frame_equal(_frame(O.gold_now(spark, silver, gold, bronze.schema), GOLD), _frame(wanted, GOLD))


def test_replay_restart_and_second_run(spark, bronze, tmpdir_run):
    src, silver, ck = (os.path.join(tmpdir_run, x) for x in ("bronze", "silver", "ck"))
    _files(bronze, src, 3, [1, 2, 0])
    last = os.path.join(src, "2.parquet")
    os.rename(last, os.path.join(tmpdir_run, "later"))
    O.run_silver_ordered(spark, src, silver, ck, bronze.schema, "1 hour", max_files=1)
    once = sorted(r[0] for r in spark.read.parquet(f"{silver}/rows").select("event_id").collect())
    # batch 1 is replayed, as after a failure before its commit: the same rows, and its drain repeated
    for name in ("1", ".1.crc"):
        os.rename(os.path.join(ck, "commits", name), os.path.join(tmpdir_run, f"gone-{name}"))
    O.run_silver_ordered(spark, src, silver, ck, bronze.schema, "1 hour", max_files=1)
    assert sorted(r[0] for r in spark.read.parquet(f"{silver}/rows").select("event_id").collect()) == once
    # what comes later, all of it older than what a drain has closed, is corrected
    os.rename(os.path.join(tmpdir_run, "later"), last)
    O.run_silver_ordered(spark, src, silver, ck, bronze.schema, "1 hour", max_files=1)
    cols = ["event_id", *BATCH_FEATURES]
    want = batch_features(quality_filter(bronze))
    pd.testing.assert_frame_equal(_frame(O.silver_now(spark, silver, bronze.schema), cols), _frame(want, cols))


def test_buffer_holds_open_readings(spark, bronze, tmpdir_run):
    src, silver = os.path.join(tmpdir_run, "bronze"), os.path.join(tmpdir_run, "silver")
    _files(bronze, src, 1, [0])
    O.run_silver_ordered(spark, src, silver, os.path.join(tmpdir_run, "ck"), bronze.schema, "1 day", drain=False)
    clean = quality_filter(bronze)
    edge = clean.agg(F.max("event_timestamp")).first()[0] - pd.Timedelta(days=1)
    out = {r[0] for r in spark.read.parquet(f"{silver}/rows").select("event_id").collect()}
    assert out == {r[0] for r in clean.where(F.col("event_timestamp") < F.lit(edge)).select("event_id").collect()}
    state = O._State(spark, silver, bronze.schema, 0)
    assert state.open.count() + len(out) == clean.count()
    assert state.tail.groupBy("pipe_segment_id").count().agg(F.max("count")).first()[0] <= 9


def test_needed_days(spark):
    counts = spark.createDataFrame([("a", d, n) for d, n in [(1, 5), (2, 5), (3, 4), (4, 0), (6, 8), (7, 1), (8, 1)]]
                                   + [("b", 1, 3)], "pipe_segment_id string, event_day int, n long")
    late = spark.createDataFrame([("a", 4)], "pipe_segment_id string, event_day int")
    got = sorted(r["event_day"] for r in O.needed_days(counts, late, 10).collect())
    assert got == [2, 3, 4, 6, 7]   # nine readings before day 4: days 3 and 2; after it: 6 and 7


def test_model_switch_between_triggers(spark, bronze, model, tmpdir_run):
    src, silver, gold, root = (os.path.join(tmpdir_run, x) for x in ("bronze", "silver", "gold", "models"))
    _files(bronze, src, 2, [0, 1])
    O.run_silver_ordered(spark, src, silver, os.path.join(tmpdir_run, "ck"), bronze.schema, "1 hour", max_files=1)
    registry.save_forest(spark, root, "leak", model, alias="production")
    other = fit_pipeline(batch_features(quality_filter(bronze)), trees=5, psi=32, seed=7)[0]
    assert registry.save_forest(spark, root, "leak", other) == 2
    asked, now = [], O.production_model(spark, root, "leak")

    def switching():
        if len(asked) == 1:
            registry.set_alias(spark, root, "leak", "production", 2)
        asked.append(now())
        return asked[-1]
    O.run_gold_ordered(spark, silver, gold, os.path.join(tmpdir_run, "ckg"), bronze.schema, switching, max_files=1)
    got = spark.read.parquet(f"{gold}/rows")
    assert {r[0] for r in got.select("model_version").distinct().collect()} == {1, 2}
    rows = spark.read.parquet(f"{silver}/rows").dropna(subset=BATCH_FEATURES)
    for v, m in ((1, model), (2, other)):
        ids = got.where(f"model_version = {v}").select("event_id")
        want = score_forest(rows.join(ids, "event_id", "left_semi"), m)
        cols = ["event_id", "anomaly_score"]
        pd.testing.assert_frame_equal(_frame(got.where(f"model_version = {v}"), cols), _frame(want, cols))
