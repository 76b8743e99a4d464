"""Message stream -> Bronze.

The sink is a parquet directory with a checkpoint: the file sink's log plus
the source offsets give exactly-once appends, so a restart after a failure
(or a second ``availableNow`` run) adds only new messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leakscope.sources.messages import parse_messages, stream_messages


def dedup_stream(df: DataFrame, delay: str = "1 hour", key: str = "event_id",
                 ts: str = "event_timestamp") -> DataFrame:
    """I9 (repair): drop repeated ``key`` within the watermark delay. The
    watermark runs on the time of arrival, not on the reading's own time: state
    stays bounded by ``delay``, and a reading that arrives late is kept, however
    old it is and however the trigger cap cuts the input."""
    arrived = df.withColumn("_arrived", F.current_timestamp())
    return (arrived.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark([key])
            .drop("_arrived"))


def bronze_stream(spark: SparkSession, fmt: str, source: str, opts: dict | None = None,
                  max_per_trigger: int | None = None, dedup_delay: str | None = None) -> DataFrame:
    """A2 + B1-B3 (+ I9): parsed Bronze rows as a streaming DataFrame."""
    parsed = parse_messages(stream_messages(spark, fmt, source, opts,
                                            max_per_trigger=max_per_trigger))
    return dedup_stream(parsed, dedup_delay) if dedup_delay else parsed


def run_bronze(spark: SparkSession, fmt: str, source: str, out_path: str, checkpoint: str,
               opts: dict | None = None, max_per_trigger: int | None = None,
               dedup_delay: str | None = None, partition_cols=("pipe_segment_id",),
               wait: bool = True, table: str | None = None) -> StreamingQuery:
    """Drain what is available (``availableNow``), append to Bronze,
    checkpointed; awaited by default (I5: empty triggers write nothing)."""
    df = bronze_stream(spark, fmt, source, opts, max_per_trigger, dedup_delay)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    q = w.toTable(table) if table else w.start(out_path)  # A10: named table or path
    if wait:
        q.awaitTermination()
    return q


def progress(q: StreamingQuery) -> list[dict]:
    """Per-trigger progress (rows in, rates, durations)."""
    return [dict(p) for p in q.recentProgress]
