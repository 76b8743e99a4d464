"""Chunked trailing windows equal plain per-segment windows (brute force in
pandas), including sparse buckets, empty buckets, NULL timestamps and ties."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from leakscope.operators.windowing import chunk_window, drop_halo, with_halo


def _frame(spark, n, seed, null_ts=False):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2024, 1, 1)
    # bursts and long gaps so that many buckets hold fewer rows than the halo
    secs = np.cumsum(rng.choice([1, 5, 60, 3600, 7 * 3600], size=n))
    rows = []
    for i in range(n):
        ts = base + dt.timedelta(seconds=int(secs[rng.integers(0, n)]))
        if null_ts and rng.random() < 0.05:
            ts = None
        rows.append((f"e{i:05d}", f"S{rng.integers(0, 3)}", ts, float(rng.normal())))
    return spark.createDataFrame(rows, "event_id string, seg string, ts timestamp_ntz, x double")


@pytest.mark.parametrize("halo,bucket,null_ts", [(9, 3600, False), (1, 600, True), (20, 86400, False),
                                                  (9, 60, True)])
def test_chunked_equals_plain(spark, halo, bucket, null_ts):
    df = _frame(spark, 600, seed=halo + bucket, null_ts=null_ts)
    order = ["ts", "event_id"]
    fr = with_halo(df, "seg", order, "ts", halo, bucket)
    w = chunk_window("seg", order)
    got = drop_halo(fr.select(
        "event_id", "_chunk", "_halo",
        F.avg("x").over(w.rowsBetween(-halo, 0)).alias("m"),
        F.lag("x", 1).over(w).alias("l"),
        F.count(F.lit(1)).over(w.rowsBetween(-halo, -1)).alias("c"))).toPandas()
    pw = Window.partitionBy("seg").orderBy(*order)
    want = df.select("event_id", F.avg("x").over(pw.rowsBetween(-halo, 0)).alias("m"),
                     F.lag("x", 1).over(pw).alias("l"),
                     F.count(F.lit(1)).over(pw.rowsBetween(-halo, -1)).alias("c")).toPandas()
    a = got.sort_values("event_id").reset_index(drop=True)
    b = want.sort_values("event_id").reset_index(drop=True)
    assert len(a) == len(b) == 600
    pd.testing.assert_series_equal(a["c"], b["c"], check_dtype=False)
    np.testing.assert_allclose(a["m"], b["m"], rtol=1e-12)
    np.testing.assert_allclose(a["l"].astype(float), b["l"].astype(float), rtol=0, equal_nan=True)


def test_hot_segment_is_split(spark):
    """A single segment spreads over many window partitions."""
    df = _frame(spark, 400, seed=3).withColumn("seg", F.lit("HOT"))
    fr = with_halo(df, "seg", ["ts", "event_id"], "ts", 9, 3600)
    assert fr.where(~F.col("_halo")).select("_chunk").distinct().count() > 10


@pytest.mark.parametrize("target", [25, 200])
def test_adaptive_width_splits_hot_key_and_stays_exact(spark, target):
    df = _frame(spark, 600, seed=11)
    hot = df.withColumn("seg", F.when(F.col("seg") == "S2", "S0").otherwise(F.col("seg")))
    order = ["ts", "event_id"]
    fr = with_halo(hot, "seg", order, "ts", 9, bucket_seconds=None, target_rows=target)
    w = chunk_window("seg", order)
    got = drop_halo(fr.select("event_id", "_chunk", "_halo",
                              F.avg("x").over(w.rowsBetween(-9, 0)).alias("m"))).toPandas()
    pw = Window.partitionBy("seg").orderBy(*order)
    want = hot.select("event_id", F.avg("x").over(pw.rowsBetween(-9, 0)).alias("m")).toPandas()
    a = got.sort_values("event_id").reset_index(drop=True)
    b = want.sort_values("event_id").reset_index(drop=True)
    np.testing.assert_allclose(a["m"], b["m"], rtol=1e-12)
    n_hot = hot.where(F.col("seg") == "S0").count()
    chunks = fr.where(~F.col("_halo") & (F.col("seg") == "S0")).select("_chunk").distinct().count()
    assert chunks >= max(2, n_hot // (4 * target))


def _chunks_and_means(df, target, halo=9):
    order = ["ts", "event_id"]
    fr = with_halo(df, "seg", order, "ts", halo, bucket_seconds=None, target_rows=target)
    w = chunk_window("seg", order)
    got = drop_halo(fr.select("event_id", "_chunk", "_halo", F.avg("x").over(w.rowsBetween(-halo, 0)).alias("m"))).toPandas()
    pw = Window.partitionBy("seg").orderBy(*order)
    want = df.select("event_id", F.avg("x").over(pw.rowsBetween(-halo, 0)).alias("m")).toPandas()
    a, b = (x.sort_values("event_id").reset_index(drop=True) for x in (got, want))
    assert list(a["event_id"]) == list(b["event_id"])
    np.testing.assert_allclose(a["m"], b["m"], rtol=1e-12)
    return fr.where(~F.col("_halo")).groupBy("seg", "_chunk").count().toPandas()["count"]


@pytest.mark.parametrize("case", ["outlier", "burst", "nulls", "one_key"])
def test_no_bucket_outgrows_its_target(spark, case):
    rng = np.random.default_rng(3)
    base = dt.datetime(2024, 1, 1)
    n, target = 3000, 100
    rows = []
    for i in range(n):
        ts = base + dt.timedelta(seconds=int(rng.integers(0, 5000)))
        if case == "burst" and i < 2000:
            ts = base + dt.timedelta(seconds=77)
        if case == "nulls" and i < 2000:
            ts = None
        rows.append((f"event-{i:09d}", "S0" if case == "one_key" else f"S{i % 2}", ts, float(rng.normal())))
    if case == "outlier":
        rows.append(("event-zzz", "S0", dt.datetime(1970, 1, 1), 1.0))
        rows.append(("event-zzy", "S1", dt.datetime(2400, 1, 1), 1.0))
    df = spark.createDataFrame(rows, "event_id string, seg string, ts timestamp_ntz, x double")
    sizes = _chunks_and_means(df, target)
    assert sizes.sum() == len(rows) and sizes.max() <= 4 * target
