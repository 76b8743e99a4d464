"""Plan shapes that carry the scale design (checked on the physical plan)."""

import re

from pyspark.sql import functions as F

from leakscope.operators import reports
from leakscope.plans import medallion as M

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_single_window_over_segment_and_chunk(spark):
    p = _plan(M.fixture_silver(spark, SF_SMALL))
    assert len(re.findall(r"\bWindow \[", p)) >= 1
    assert "hashpartitioning(pipe_segment_id" in p and "_chunk" in p
    assert "WindowGroupLimit" in p                       # tails are cut before their shuffle
    # the five feature windows share one Window operator
    top_window = p[p.index("Window ["):p.index("\n", p.index("Window ["))]
    assert top_window.count("windowspecdefinition") >= 5


def test_dashboards_partial_aggregation_and_pruning(spark, tmp_path):
    from leakscope.operators.gold import gold_table
    from leakscope.sources.tables import replace
    path = str(tmp_path / "gold")
    replace(gold_table(M.fixture_gold(spark, SF_SMALL)), path, ["pipe_segment_id", "severity"])
    g = spark.read.parquet(path)
    p = _plan(reports.segment_risk_summary(g))
    assert p.count("HashAggregate") >= 2                 # partial + final
    p = _plan(reports.critical_digest(g))
    assert "PartitionFilters: [isnotnull(severity" in p and "CRITICAL" in p
    p = _plan(reports.latest_reading(g))
    assert "WindowGroupLimit" in p
    p = _plan(reports.worst_alerts(g))
    assert "TakeOrderedAndProject" in p
    p = _plan(reports.kpi(g))
    assert re.search(r"ReadSchema: struct<pressure_psi:double>", p)


def test_silver_runtime_plan_scans_input_three_times(spark):
    df = M.fixture_silver(spark, SF_SMALL)
    df.collect()  # executes this frame's own query: its adaptive plan is now final
    final = _plan(df).split("+- == Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) == 3    # rows, bucket tails, bucket counts
    assert "ReusedExchange" in final                       # the counts are computed once


def test_writers_rebalance_instead_of_one_task_per_value(spark, tmp_path):
    from leakscope.sources.tables import _writer
    df = spark.range(1000).selectExpr("id", "'hot' as seg")
    plan = _writer(df, "overwrite", ["seg"])._df._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
