"""Print the physical operator outline of the headline queries.

    python scripts/show_plans.py [sf_dir]

Shows, per query, the final adaptive plan's operators that carry the scale design (exchanges,
windows, partial aggregates, top-k, broadcasts, Python stages) in plan order.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = re.compile(r"(ReusedExchange|Exchange \w+(\([^)]*\))?|Window \[|WindowGroupLimit|ObjectHashAggregate|SortAggregate|HashAggregate|TakeOrderedAndProject|"
                  r"BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin|ArrowEvalPython|"
                  r"FlatMapGroupsInPandas|Union|Generate|Scan parquet|PartitionFilters: \[[^\]]*\])")


def outline(df) -> list[str]:
    """Outline of the final adaptive plan: the frame is executed first (its
    own query execution), so reused exchanges and runtime broadcasts show."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    out = []
    for line in plan.splitlines():
        m = KEEP.search(line)
        if m:
            depth = (len(line) - len(line.lstrip(" :+-"))) // 3
            out.append("  " * depth + m.group(0)[:90])
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from leakscope.operators import reports
    from leakscope.operators.forest import fit_pipeline, score_forest
    from leakscope.operators.gold import gold_table
    from leakscope.plans import medallion as M
    from leakscope.session import build_session
    from leakscope.sources.tables import replace
    spark = build_session()
    d = tempfile.mkdtemp(prefix="plans-")
    replace(gold_table(M.fixture_gold(spark, sf)), f"{d}/gold", ["pipe_segment_id", "severity"])
    gold = spark.read.parquet(f"{d}/gold")
    silver = M.fixture_silver(spark, sf)
    model, _ = fit_pipeline(silver, trees=20, psi=64)
    shown = {
        "Silver features (E1-E7)": silver,
        "Segment risk summary (D4)": reports.segment_risk_summary(gold),
        "Critical digest (D6)": reports.critical_digest(gold),
        "Latest reading (E13)": reports.latest_reading(gold),
        "Forest scoring (J5)": score_forest(silver, model),
    }
    for name, df in shown.items():
        print(f"== {name}")
        print("\n".join(outline(df)))


if __name__ == "__main__":
    main()
