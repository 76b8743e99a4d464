"""Bronze that a replay cannot duplicate, and a kept progress log.

A message is its event_id together with its event time's day, both of which a
replayed message repeats. Every trigger writes its new messages, and their
keys, to folders of its run and batch with overwrite (a trigger repeated after a
failure replaces its own output). New are those whose key no other trigger has
stored, however long ago: the stored keys are partitioned by day, only the days
that the trigger's messages name are read, and they are first cut down to the
trigger's own keys (which Spark broadcasts where they are few), so a trigger's
work follows its messages and not the history. Readings without a usable
time form a day of their own.

A run is a checkpoint: its number is stored beside the checkpoint, so that a
stream restarted with a new checkpoint over the same messages adds nothing and
overwrites nothing.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from leakscope.schemas import EVENT_ID, EVENT_TS
from leakscope.sources.versions import create_with, names
from leakscope.streaming.bronze import bronze_stream

NO_DAY = -1_000_000  # before every date
KEYS = StructType([StructField(EVENT_ID, StringType()), StructField("run", StringType()), StructField("batch", LongType()),
                   StructField("event_day", IntegerType())])


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The run that this checkpoint belongs to."""
    path = f"{checkpoint}-run"
    if "_SUCCESS" not in names(spark, path):
        spark.createDataFrame([(uuid.uuid4().hex,)], "run string").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["run"]


def with_day(df: DataFrame) -> DataFrame:
    day = F.unix_date(F.to_date(EVENT_TS))
    return df.withColumn("event_day", F.coalesce(day, F.lit(NO_DAY)))


def new_messages(rows: DataFrame, keys_path: str, run: str, batch: int) -> DataFrame:
    """Of ``rows`` (with ``event_day``) one row of every key that no other
    trigger has stored."""
    spark = rows.sparkSession
    w = Window.partitionBy(EVENT_ID, "event_day").orderBy(*[c for c in rows.columns if c not in (EVENT_ID, "event_day")])
    once = rows.withColumn("_i", F.row_number().over(w)).where("_i = 1").drop("_i")
    if not any(n.startswith("run=") for n in names(spark, keys_path)):
        return once
    own = rows.select(EVENT_ID, "event_day").distinct()
    days = [r[0] for r in own.select("event_day").distinct().collect()]  # as many as the messages' days
    stored = (spark.read.schema(KEYS).parquet(keys_path).where(F.col("event_day").isin(days))
              .where((F.col("run") != run) | (F.col("batch") < batch)))
    known = stored.join(own, [EVENT_ID, "event_day"], "left_semi").select(EVENT_ID, "event_day").distinct()
    return once.join(known, [EVENT_ID, "event_day"], "left_anti")


def run_bronze_once(spark: SparkSession, fmt: str, source: str, out_path: str, keys_path: str, checkpoint: str,
                    opts: dict | None = None, max_per_trigger: int | None = None) -> StreamingQuery:
    """Drain the messages that are there into ``out_path``; each message enters
    once over all runs that share ``keys_path``."""
    run = run_name(spark, checkpoint)

    def process(batch: DataFrame, k: int) -> None:
        rows = with_day(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = new_messages(rows, keys_path, run, k)
            new.write.mode("overwrite").partitionBy("event_day").parquet(f"{out_path}/run={run}/batch={k}")
            # the keys are those of the stored rows, so both agree after any failure
            stored = rows.sparkSession.read.schema(new.schema).parquet(f"{out_path}/run={run}/batch={k}")
            (stored.select(EVENT_ID, "event_day").write.mode("overwrite").partitionBy("event_day")
             .parquet(f"{keys_path}/run={run}/batch={k}"))
        finally:
            rows.unpersist()

    q = (bronze_stream(spark, fmt, source, opts, max_per_trigger).writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


PROGRESS = "query string, run string, at double, kind string, batch long, rows long, payload string"


class ProgressLog(StreamingQueryListener):
    """Every start, progress report and end (with its error) of the
    session's queries, appended to a table. ``with ProgressLog(spark, path):``
    listens while the block runs; ``read`` gives the table back at any time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.failed = spark, path, []

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def _append(self, event, kind: str, batch: int | None = None, rows: int | None = None, payload: str = "") -> None:
        row = {"query": str(event.id), "run": str(event.runId), "at": time.time(), "kind": kind, "batch": batch, "rows": rows,
               "payload": payload}
        try:  # a file of its own for each event: events of several queries come at once
            create_with(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", json.dumps(row))
        except Exception as e:  # noqa: BLE001 - a listener must not end the query; the caller sees what was lost
            self.failed.append((row, str(e)))

    def onQueryStarted(self, event) -> None:
        self._append(event, "started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._append(p, "progress", p.batchId, p.numInputRows, p.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._append(event, "failed" if event.exception else "ended", payload=event.exception or "")

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(self.path)


def rates(log: DataFrame) -> DataFrame:
    """Per query run: triggers, rows, slowest trigger in ms, last state."""
    ms = F.get_json_object("payload", "$.durationMs.triggerExecution").cast("long")
    return log.groupBy("query", "run").agg(
        F.count_if(F.col("kind") == "progress").alias("triggers"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.max(ms).alias("slowest_ms"), F.max_by("kind", "at").alias("state"),
        F.max(F.when(F.col("kind") == "failed", F.col("payload"))).alias("error"))

