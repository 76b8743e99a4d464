"""The batch medallion job: Bronze -> Silver -> Gold, as plain callables.

The reference runs these as scheduled notebook tasks; here each step is a
function of DataFrames, and ``run_batch`` shows the order. Tables are written
partitioned (Silver by segment, Gold by segment and severity) so dashboard
filters prune partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.operators.features import batch_features
from leakscope.operators.forest import fit_and_score
from leakscope.operators.gold import classify, gold_table, prediction_from_score
from leakscope.operators.lineage import as_table
from leakscope.operators.quality import quality_filter
from leakscope.operators.windowing import DEFAULT_BUCKET_SECONDS, TARGET_ROWS, plan_buckets
from leakscope.schemas import EVENT_ID, EVENT_TS, SEGMENT
from leakscope.sources import fixtures as fx


def silver(bronze: DataFrame, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
           with_clock: bool = False, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Bronze -> quality filter -> batch features (+ ``silver_ts``). The
    filtered rows are written once: the bucket plan, the counts, the halos and
    the windows each read them, the first three a few narrow columns only, and
    none parses and filters Bronze again."""
    plan = None
    rows = as_table(quality_filter(bronze), "filtered")
    if bucket_seconds is None:
        plan = plan_buckets(rows, SEGMENT, EVENT_TS, EVENT_ID, target_rows)
    out = batch_features(rows, bucket_seconds=bucket_seconds, plan=plan, target_rows=target_rows)
    return out.withColumn("silver_ts", F.current_timestamp()) if with_clock else out


def standin_gold(silver_df: DataFrame) -> DataFrame:
    """Gold rows from the closed-form stand-in score (test fixture for the
    dashboards): score, prediction, severity, message."""
    scored = (silver_df.withColumn("anomaly_score", fx.standin_score())
              .withColumn("anomaly_prediction", prediction_from_score()))
    return classify(scored)


def fixture_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.bronze(spark, sf_dir)


def fixture_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(fx.bronze_parsed(spark, sf_dir))


def fixture_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin_gold(fixture_silver(spark, sf_dir))


def model_gold(silver_df: DataFrame, trees: int = 200, psi: int = 256,
               contamination: float = 0.08, seed: int = 42, cut: float = -0.07, scaled: bool = True):
    """Silver -> forest fit -> scored and classified Gold rows. Returns (gold, model)."""
    silver_df = as_table(silver_df, "silver")  # read by split, scaler, sampling and scoring, each some columns
    scored, model = fit_and_score(silver_df, trees=trees, psi=psi, contamination=contamination,
                                  seed=seed, scaled=scaled)
    return classify(scored, cut=cut), model


def run_batch(spark: SparkSession, bronze: DataFrame, out_dir: str) -> dict:
    """Whole batch job: writes Silver and Gold parquet tables under ``out_dir``."""
    from leakscope.sources.tables import replace
    s = silver(bronze, with_clock=True)
    s_path = f"{out_dir}/silver_sensor_clean"
    replace(s, s_path, ["pipe_segment_id"])
    s = spark.read.parquet(s_path)
    gold, model = model_gold(s.drop("silver_ts"))
    g_path = f"{out_dir}/gold_alerts"
    replace(gold_table(gold), g_path, ["pipe_segment_id", "severity"])
    return {"silver": s_path, "gold": g_path, "offset": model.offset}


def run_streaming(spark: SparkSession, fmt: str, source: str, lake: str, model,
                  opts: dict | None = None, max_per_trigger: int | None = None,
                  dedup_delay: str | None = None, silver_files: int | None = None,
                  delay: str | float = "1 hour") -> dict:
    """Streaming job order: messages -> Bronze -> reorder buffer -> Silver -> Gold.

    Each stage drains what is available (``availableNow``) and keeps its own
    checkpoint under ``lake/_checkpoints``, so re-running the job processes only
    new messages, and a failed run resumes where its checkpoints stop.
    ``silver_files`` bounds the Bronze files that one Silver trigger takes, and
    ``delay`` how long readings wait for earlier ones; neither changes Silver or
    Gold. ``model`` is a forest, or ``ordered.production_model`` to ask the
    registry at every trigger. ``ordered.silver_now`` and ``ordered.gold_now``
    read the tables; ``schema`` is the Bronze schema that they need."""
    from pyspark.sql.types import TimestampType

    from leakscope.schemas import bronze_schema
    from leakscope.streaming.bronze import run_bronze
    from leakscope.streaming.ordered import run_gold_ordered, run_silver_ordered
    ck = f"{lake}/_checkpoints"
    b, s, g = f"{lake}/bronze", f"{lake}/silver", f"{lake}/gold"
    run_bronze(spark, fmt, source, b, f"{ck}/bronze", opts, max_per_trigger, dedup_delay)
    schema = bronze_schema(TimestampType())  # parsed message times are instants
    run_silver_ordered(spark, b, s, f"{ck}/silver", schema, delay, max_files=silver_files)
    run_gold_ordered(spark, s, g, f"{ck}/gold", schema, model)
    return {"bronze": b, "silver": s, "gold": g, "schema": schema}


def main(argv=None) -> None:
    """``python -m leakscope.plans.medallion BRONZE_PARQUET OUT_DIR``: batch job."""
    import argparse
    import json

    from leakscope.session import build_session
    p = argparse.ArgumentParser(description=main.__doc__)
    p.add_argument("bronze")
    p.add_argument("out")
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)
    spark = build_session(master=a.master)
    print(json.dumps(run_batch(spark, spark.read.parquet(a.bronze), a.out)))


if __name__ == "__main__":
    main()
