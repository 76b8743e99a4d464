"""Writers, schema evolution, partition pruning, audit and CSV export."""

import os

from pyspark.sql import functions as F

from leakscope.operators.joins import new_only
from leakscope.plans import medallion as M
from leakscope.sources import fixtures as fx
from leakscope.sources.tables import (append, append_evolving, export_csv, load, replace,
                                      table_audit)

from tests.conftest import SF_SMALL


def test_replace_append_evolve_audit_export(spark, tmpdir_run):
    gold = M.fixture_gold(spark, SF_SMALL).withColumn("gold_ts", F.current_timestamp())
    gpath = os.path.join(tmpdir_run, "gold")
    replace(gold, gpath, ["pipe_segment_id", "severity"])
    g = load(spark, gpath)
    assert g.count() == gold.count()
    plan = g.where(F.col("severity") == "CRITICAL")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "CRITICAL" in plan
    # append twice -> duplicates; backfill through the anti join adds nothing new
    b = fx.bronze(spark, SF_SMALL)
    bpath = os.path.join(tmpdir_run, "bronze")
    append(b, bpath, ["pipe_segment_id"])
    append(new_only(b, load(spark, bpath)), bpath, ["pipe_segment_id"])
    assert load(spark, bpath).count() == b.count()
    # schema evolution: a later batch adds silver_ts
    spath = os.path.join(tmpdir_run, "silver")
    s = M.fixture_silver(spark, SF_SMALL)
    append_evolving(s, spath)
    append_evolving(s.withColumn("silver_ts", F.current_timestamp()), spath)
    merged = load(spark, spath, merge_schema=True)
    assert "silver_ts" in merged.columns and merged.count() == 2 * s.count()
    audit = {r.table_name: r for r in table_audit(spark, [(bpath, "ingestion_ts"), (gpath, "gold_ts"),
                                                          (os.path.join(tmpdir_run, "nope"), "x")]).collect()}
    assert audit[bpath].status == "ok" and audit[gpath].latest is not None
    assert audit[os.path.join(tmpdir_run, "nope")].status == "missing table"
    cpath = os.path.join(tmpdir_run, "csv")
    export_csv(g.where(F.col("severity") == "CRITICAL"), cpath)
    back = spark.read.option("header", True).csv(cpath)
    assert back.count() == g.where(F.col("severity") == "CRITICAL").count()


def test_catalog_tables_ddl(spark):
    from leakscope.sources.tables import bootstrap, describe, drop_table, list_tables
    bootstrap(spark, "ls_pipeline")
    name = "ls_pipeline.gold_alerts"
    g = M.fixture_gold(spark, SF_SMALL).select("event_id", "pipe_segment_id", "severity", "anomaly_score")
    replace(g, name, ["pipe_segment_id", "severity"])
    append(g.limit(3), name, ["pipe_segment_id", "severity"])
    assert load(spark, name).count() == g.count() + 3
    assert "gold_alerts" in [r.tableName for r in list_tables(spark, "ls_pipeline").collect()]
    assert "anomaly_score" in [r.col_name for r in describe(spark, name).collect()]
    drop_table(spark, name)
    assert "gold_alerts" not in [r.tableName for r in list_tables(spark, "ls_pipeline").collect()]


def test_run_batch_end_to_end(spark, tmpdir_run):
    from leakscope.operators import reports
    out = os.path.join(tmpdir_run, "lake")
    info = M.run_batch(spark, fx.bronze(spark, SF_SMALL), out)
    silver, gold = load(spark, info["silver"]), load(spark, info["gold"])
    assert silver.count() == gold.count() == M.fixture_silver(spark, SF_SMALL).count()
    assert {"silver_ts"} <= set(silver.columns) and {"gold_ts", "severity"} <= set(gold.columns)
    assert os.path.isdir(os.path.join(info["gold"], "pipe_segment_id=PIPE-001"))
    kpi = reports.kpi(gold).first()
    assert kpi.critical_events + kpi.warning_events + kpi.normal_events == gold.count()
    audit = {r.table_name: r.status for r in table_audit(
        spark, [(info["silver"], "silver_ts"), (info["gold"], "gold_ts")]).collect()}
    assert set(audit.values()) == {"ok"}
