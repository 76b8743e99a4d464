"""Sensor messages in and out.

A message is a key (segment) and a JSON ``value``. The same functions read
Kafka (``fmt="kafka"``; needs the Kafka connector on the cluster) or files
that hold a ``value`` column (json/parquet) or one JSON document per line
(text), which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leakscope.schemas import MESSAGE_FIELDS, MESSAGE_SCHEMA

# Bounded Kafka read from the first to the last offset. The stream
# also starts at the first offset, so nothing that arrives between a batch read
# and the first trigger is lost (C2's anti-join drops what the batch had). There
# is no rate cap unless the caller gives one.
KAFKA_BATCH_OPTIONS = {"startingOffsets": "earliest", "endingOffsets": "latest"}
KAFKA_STREAM_OPTIONS = {"startingOffsets": "earliest"}


def _reader(r, fmt: str, opts: dict | None):
    r = r.format(fmt)
    for k, v in (opts or {}).items():
        r = r.option(k, v)
    return r


def _value_frame(df: DataFrame, fmt: str) -> DataFrame:
    """Kafka (binary ``value``), text (one document per line) and json/parquet
    files with a ``value`` column all end as one string column."""
    return df.select(F.col("value").cast("string").alias("value"))


def read_messages(spark: SparkSession, fmt: str, path_or_topic: str | None = None,
                  opts: dict | None = None) -> DataFrame:
    """A1: bounded read of messages -> one string column ``value``."""
    o = dict(KAFKA_BATCH_OPTIONS, subscribe=path_or_topic, **(opts or {})) if fmt == "kafka" \
        else dict(opts or {})
    r = _reader(spark.read, fmt, o)
    df = r.load() if fmt == "kafka" else r.load(path_or_topic)
    return _value_frame(df, fmt)


def stream_messages(spark: SparkSession, fmt: str, path_or_topic: str,
                    opts: dict | None = None, schema: StructType | None = None,
                    max_per_trigger: int | None = None) -> DataFrame:
    """A2 + I2: unbounded read, with a per-trigger cap where the caller gives one
    (offsets for Kafka, files for file sources)."""
    if fmt == "kafka":
        o = dict(KAFKA_STREAM_OPTIONS, subscribe=path_or_topic, **(opts or {}))
        if max_per_trigger:
            o["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return _value_frame(_reader(spark.readStream, fmt, o).load(), fmt)
    o = dict(opts or {})
    if max_per_trigger:
        o["maxFilesPerTrigger"] = str(max_per_trigger)
    r = _reader(spark.readStream, fmt, o)
    if fmt != "text":
        r = r.schema(schema or StructType().add("key", "string").add("value", "string"))
    return _value_frame(r.load(path_or_topic), fmt)


def parse_json(value: Column, schema: StructType | str) -> Column:
    """B1: JSON text -> struct (a struct of NULLs for junk, never an error)."""
    return F.from_json(value.cast("string"), schema)


def parse_messages(values: DataFrame, schema: StructType = MESSAGE_SCHEMA,
                   with_clock: bool = True) -> DataFrame:
    """JSON -> typed columns; ISO-8601 time (with offset) -> timestamp,
    NULL when unparsable; ``ingestion_ts`` added; rows without event_id or
    segment dropped."""
    out = (values.select(parse_json(F.col("value"), schema).alias("data")).select("data.*")
           .withColumn("event_timestamp", F.try_to_timestamp(F.col("event_timestamp"))))
    if with_clock:
        out = out.withColumn("ingestion_ts", F.current_timestamp())
    return out.dropna(subset=["event_id", "pipe_segment_id"])


def to_messages(df: DataFrame, fields: list[str] = MESSAGE_FIELDS) -> DataFrame:
    """key = segment, value = JSON of the reading; the timestamp is written
    as ISO-8601 text with offset."""
    cols = [F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c)
            if c == "event_timestamp" else F.col(c) for c in fields]
    return df.select(F.col("pipe_segment_id").alias("key"),
                     F.to_json(F.struct(*cols)).alias("value"))


def write_messages(df: DataFrame, fmt: str, target: str, opts: dict | None = None) -> None:
    """Sink for A15 rows: Kafka topic or a directory of JSON files."""
    if fmt == "kafka":
        w = df.write.format("kafka").option("topic", target)
        for k, v in (opts or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        df.write.mode("append").format(fmt).save(target)
