"""Streaming: messages -> Bronze (junk, bad time, duplicates, restart),
micro-batch Silver, stateful Silver equal to batch features, stream Gold."""

import os

import pandas as pd
from pyspark.sql import functions as F

from leakscope.operators.features import batch_features, microbatch_features
from leakscope.operators.quality import quality_filter
from leakscope.schemas import BRONZE_COLUMNS, BATCH_FEATURES
from leakscope.sources import fixtures as fx
from leakscope.sources.messages import to_messages
from leakscope.streaming.bronze import progress, run_bronze
from leakscope.streaming.silver import complete, run_silver_microbatch, run_silver_stateful

from tests.conftest import SF_SMALL


def _write_message_files(spark, bronze, d, k=3):
    """k JSON-lines files in time order + hand-made junk lines."""
    pdf = to_messages(bronze).toPandas()
    ts = bronze.select("event_timestamp").toPandas()["event_timestamp"]
    pdf = pdf.assign(_t=ts.values).sort_values("_t").drop(columns="_t")
    parts = [pdf.iloc[int(len(pdf) * j / k):int(len(pdf) * (j + 1) / k)] for j in range(k)]
    os.makedirs(d, exist_ok=True)
    t0 = 1_700_000_000
    for j, part in enumerate(parts):
        path = os.path.join(d, f"part-{j:03d}.json")
        with open(path, "w") as fh:
            for v in part["value"]:
                fh.write(v + "\n")
        os.utime(path, (t0 + j, t0 + j))  # arrival order = modification time order
    return pdf


def test_messages_to_bronze_restart_and_dedup(spark, tmpdir_run):
    bronze = fx.bronze(spark, SF_SMALL).where(F.col("pressure_psi").isNotNull())
    src = os.path.join(tmpdir_run, "msgs")
    pdf = _write_message_files(spark, bronze, src)
    first = pdf["value"].iloc[0]
    with open(os.path.join(src, "part-900.json"), "w") as fh:
        fh.write("junk\n{}\n")
        fh.write('{"event_id":"bad-ts","pipe_segment_id":"PIPE-001","event_timestamp":"junk",'
                 '"pressure_psi":1.0,"flow_rate_lpm":1.0,"acoustic_g_rms":0.1,"temperature_c":1.0,'
                 '"is_anomaly":"normal"}\n')
        fh.write(first + "\n")  # exact duplicate in a later file
    out, ck = os.path.join(tmpdir_run, "bronze"), os.path.join(tmpdir_run, "ck")
    q = run_bronze(spark, "text", src, out, ck, max_per_trigger=2)
    got = spark.read.parquet(out)
    n = got.count()
    assert n == len(pdf) + 2  # junk and {} dropped; bad time kept; duplicate kept
    assert got.where(F.col("event_id") == "bad-ts").first()["event_timestamp"] is None
    assert len(progress(q)) >= 2  # rate cap -> several triggers
    # restart: nothing new
    run_bronze(spark, "text", src, out, ck)
    assert spark.read.parquet(out).count() == n
    # the repaired stream drops the duplicate event_id
    out2, ck2 = os.path.join(tmpdir_run, "bronze2"), os.path.join(tmpdir_run, "ck2")
    run_bronze(spark, "text", src, out2, ck2, dedup_delay="1 hour")
    assert spark.read.parquet(out2).count() == n - 1


def test_microbatch_silver_single_batch_equals_batch_form(spark, tmpdir_run):
    bronze = fx.bronze(spark, SF_SMALL)
    bpath = os.path.join(tmpdir_run, "bronze")
    bronze.write.parquet(bpath)
    spath = os.path.join(tmpdir_run, "silver")
    run_silver_microbatch(spark, bpath, spath, os.path.join(tmpdir_run, "ck"), bronze.schema)
    got = spark.read.parquet(spath).drop("silver_ts", "batch_id")
    want = microbatch_features(bronze, with_clock=False)
    cols = ["event_id", "pressure_delta", "flow_imbalance", "acoustic_zscore"]
    a = got.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


def test_stateful_silver_equals_batch_features_over_files(spark, tmpdir_run):
    bronze = fx.bronze(spark, SF_SMALL)
    bpath = os.path.join(tmpdir_run, "bronze")
    # four files in time order -> four micro-batches
    days = [(1, 8), (8, 15), (15, 22), (22, 32)]
    for i, (d0, d1) in enumerate(days):
        (bronze.where((F.dayofmonth("event_timestamp") >= d0) & (F.dayofmonth("event_timestamp") < d1))
         .coalesce(1).write.mode("append").parquet(bpath))
    spath = os.path.join(tmpdir_run, "silver")
    run_silver_stateful(spark, bpath, spath, os.path.join(tmpdir_run, "ck"), bronze.schema,
                        max_files=1)
    got = complete(spark.read.parquet(spath)).drop("silver_ts")
    want = batch_features(quality_filter(bronze))
    cols = ["event_id"] + BATCH_FEATURES
    a = got.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    assert len(a) == len(b)
    pd.testing.assert_frame_equal(a, b)


def test_bounded_message_read_and_stream_gold(spark, tmpdir_run):
    from leakscope.operators.forest import fit_pipeline, score_forest
    from leakscope.operators.gold import classify, gold_table
    from leakscope.plans import medallion as M
    from leakscope.sources.messages import parse_messages, read_messages
    from leakscope.streaming.gold import run_gold

    bronze = fx.bronze(spark, SF_SMALL)
    mpath = os.path.join(tmpdir_run, "messages")
    to_messages(bronze).write.json(mpath)          # files with key / value columns
    parsed = parse_messages(read_messages(spark, "json", mpath))
    assert parsed.count() == bronze.count()
    assert dict(parsed.dtypes)["event_timestamp"] == "timestamp"

    silver = M.fixture_silver(spark, SF_SMALL)
    spath = os.path.join(tmpdir_run, "silver")
    silver.repartition(3).write.parquet(spath)
    model, _ = fit_pipeline(silver, trees=20, psi=64)
    gpath = os.path.join(tmpdir_run, "gold")
    run_gold(spark, spath, gpath, os.path.join(tmpdir_run, "ck"), silver.schema, model, max_files=1)
    got = spark.read.parquet(gpath).select("event_id", "anomaly_score", "severity", "alert_message")
    want = gold_table(classify(score_forest(silver, model)), with_clock=False) \
        .select("event_id", "anomaly_score", "severity", "alert_message")
    a = got.toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_stateful_silver_late_row_not_reordered(spark, tmpdir_run):
    bronze = quality_filter(fx.bronze(spark, SF_SMALL))
    pdf = bronze.toPandas().sort_values(["event_timestamp", "event_id"])
    seg = pdf.pipe_segment_id.iloc[0]
    seg_rows = pdf[pdf.pipe_segment_id == seg]
    late_id = seg_rows.event_id.iloc[len(seg_rows) // 4]           # an early reading ...
    cut = pdf.event_timestamp.iloc[len(pdf) // 2]
    first = bronze.where((F.col("event_timestamp") < F.lit(cut)) & (F.col("event_id") != late_id))
    second = bronze.where((F.col("event_timestamp") >= F.lit(cut)) | (F.col("event_id") == late_id))
    bpath = os.path.join(tmpdir_run, "bronze")
    first.coalesce(1).write.parquet(bpath)
    second.coalesce(1).write.mode("append").parquet(bpath)          # ... arriving late
    spath = os.path.join(tmpdir_run, "silver")
    run_silver_stateful(spark, bpath, spath, os.path.join(tmpdir_run, "ck"), bronze.schema,
                        max_files=1)
    all_rows = spark.read.parquet(spath).drop("silver_ts")
    # every cleaned row is there once; the late one without features
    assert sorted(r.event_id for r in all_rows.select("event_id").collect()) == sorted(pdf.event_id)
    late_row = all_rows.where("late").collect()
    assert [r.event_id for r in late_row] == [late_id]
    assert all(late_row[0][c] is None for c in BATCH_FEATURES)
    got = complete(all_rows)
    from leakscope.streaming.silver import late_counts
    late = {r.pipe_segment_id: r.late_rows for r in late_counts(spark, os.path.join(tmpdir_run, "ck")).collect()}
    assert late[seg] == 1 and sum(late.values()) == 1
    want = batch_features(bronze.where(F.col("event_id") != late_id))
    cols = ["event_id"] + BATCH_FEATURES
    a = got.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_streaming_job_order_messages_to_gold(spark, tmpdir_run):
    from leakscope.operators.forest import fit_pipeline, score_forest
    from leakscope.operators.gold import classify, gold_table
    from leakscope.plans import medallion as M

    bronze = fx.bronze(spark, SF_SMALL)
    src = os.path.join(tmpdir_run, "msgs")
    _write_message_files(spark, bronze, src, k=3)
    silver = M.fixture_silver(spark, SF_SMALL)
    model, _ = fit_pipeline(silver, trees=20, psi=64)
    lake = os.path.join(tmpdir_run, "lake")
    paths = M.run_streaming(spark, "text", src, lake, model, max_per_trigger=1)
    from leakscope.streaming.ordered import gold_now
    got = gold_now(spark, paths["silver"], paths["gold"], paths["schema"])
    assert got.count() == silver.count()
    want = gold_table(classify(score_forest(silver, model)), with_clock=False)
    cols = ["event_id", "anomaly_score", "severity", "alert_message"]
    a = got.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    # a second run finds nothing new
    M.run_streaming(spark, "text", src, lake, model)
    assert gold_now(spark, paths["silver"], paths["gold"], paths["schema"]).count() == silver.count()


def test_messages_to_stateful_silver_one_query(spark, tmpdir_run):
    from leakscope.streaming.silver import late_counts, run_messages_to_silver
    bronze = fx.bronze(spark, SF_SMALL)
    src = os.path.join(tmpdir_run, "msgs")
    _write_message_files(spark, bronze, src, k=4)   # four files in time order
    out, ck = os.path.join(tmpdir_run, "silver"), os.path.join(tmpdir_run, "ck")
    run_messages_to_silver(spark, "text", src, out, ck, max_per_trigger=1)
    got = complete(spark.read.parquet(out))
    want = batch_features(quality_filter(bronze))
    cols = ["event_id"] + BATCH_FEATURES
    a = got.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    b = want.select(cols).toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    assert sum(r.late_rows for r in late_counts(spark, ck).collect()) == 0


def test_caps_do_not_change_which_rows_are_kept(spark, tmpdir_run):
    """Three files, the last one 12 hours late: cap 1, cap 3 and no cap give the
    same Bronze and the same Silver, late rows included."""
    bronze = quality_filter(fx.bronze(spark, SF_SMALL))
    src = os.path.join(tmpdir_run, "msgs")
    _write_message_files(spark, bronze, src, k=3)
    with open(os.path.join(src, "part-000.json")) as fh:
        old = fh.readline().replace('"event_id":"', '"event_id":"x')
    with open(os.path.join(src, "part-800.json"), "w") as fh:
        fh.write(old + "\n")
    kept = {}
    for cap in (1, 3, None):
        out, ck = os.path.join(tmpdir_run, f"b{cap}"), os.path.join(tmpdir_run, f"ck{cap}")
        run_bronze(spark, "text", src, out, ck, max_per_trigger=cap, dedup_delay="1 hour")
        rows = spark.read.parquet(out)
        silver, ck2 = os.path.join(tmpdir_run, f"s{cap}"), os.path.join(tmpdir_run, f"ck2{cap}")
        run_silver_stateful(spark, out, silver, ck2, rows.schema, max_files=cap)
        s = spark.read.parquet(silver)
        kept[cap] = (sorted(r.event_id for r in rows.select("event_id").collect()),
                     sorted(r.event_id for r in s.select("event_id").collect()))
    assert kept[1] == kept[3] == kept[None]
    assert kept[1][0] == kept[1][1] and len(kept[1][0]) == bronze.count() + 1


def test_bronze_named_table(spark, tmpdir_run):
    bronze = fx.bronze(spark, SF_SMALL)
    src = os.path.join(tmpdir_run, "msgs")
    _write_message_files(spark, bronze, src, k=2)
    spark.sql("DROP TABLE IF EXISTS bronze_named")
    run_bronze(spark, "text", src, "", os.path.join(tmpdir_run, "ck"), table="bronze_named")
    assert spark.table("bronze_named").count() == bronze.count()
    spark.sql("DROP TABLE bronze_named")
