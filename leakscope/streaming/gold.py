"""I8: Silver stream -> Gold. Scoring is stateless (a vectorised UDF over the
broadcast node arrays plus column expressions), so it runs directly on the
stream; Gold is appended partitioned by (segment, severity)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leakscope.operators.forest import ForestModel, score_forest
from leakscope.operators.gold import classify, gold_table
from leakscope.sources.tables import stream_table
from leakscope.streaming.silver import complete


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
             schema: StructType, model: ForestModel, cut: float = -0.07,
             max_files: int | None = None, wait: bool = True) -> StreamingQuery:
    rows = stream_table(spark, silver_path, schema, max_files)
    if "late" in schema.names:  # stateful Silver: rows with all features are scored
        rows = complete(rows)
    g = gold_table(classify(score_forest(rows, model), cut=cut))
    q = (g.writeStream.format("parquet").outputMode("append")
         .partitionBy("pipe_segment_id", "severity")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(gold_path))
    if wait:
        q.awaitTermination()
    return q
