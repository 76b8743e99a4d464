"""Bronze stream -> Silver.

I6 keeps the reference's micro-batch semantics: features are computed inside
each micro-batch (``foreachBatch``), so the first reading of every segment
in a batch has no delta and the z baseline is the batch. Each batch is written
to its own ``batch_id=`` directory with overwrite, so a replayed batch after
a failure replaces its own output instead of duplicating it.

I7 carries the trailing rows of every segment across micro-batches in state
(``applyInPandasWithState``), giving the batch features E1-E7 on a stream.
The state per segment is the last ``n - 1`` clean readings. A group's input is
one segment's rows of one trigger, which the caller bounds with the trigger's
cap; the cap never decides whether a row is kept.

Every cleaned reading leaves I7 exactly once, with ``late`` telling how. On time
(``late`` false): features over the readings before it, NULL where there are too
few. Late (older than its segment's state): all features NULL, never reordered.
Silver holds both; the batch definition's rows are those on time without NULLs
(``complete``).
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from leakscope.functions.rounding import round_half_up as rhu
from leakscope.operators.features import microbatch_features
from leakscope.operators.quality import quality_filter
from leakscope.schemas import BATCH_FEATURES, BRONZE_COLUMNS, SEGMENT
from leakscope.sources.tables import stream_table


def run_silver_microbatch(spark: SparkSession, bronze_path: str, silver_path: str,
                          checkpoint: str, schema: StructType, baseline: float = 1000.0,
                          max_files: int | None = None, wait: bool = True) -> StreamingQuery:
    """I6 (+ I5): per-micro-batch E8-E11 written per batch id."""
    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # the feature plan reads the batch several times (bucket plan, counts,
        # tails, rows, segment statistics): keep the bounded micro-batch cached
        rows = batch.select(*BRONZE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = microbatch_features(rows, baseline)
            out.write.mode("overwrite").parquet(f"{silver_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    rows = stream_table(spark, bronze_path, schema, max_files)
    q = (rows.writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


RAW_FEATURES = ["_p_avg", "_f_avg", "_a_avg", "_p_delta", "_a_std"]
_STATE_COLS = ["event_timestamp_us", "event_id", "pressure_psi", "flow_rate_lpm", "acoustic_g_rms"]
STATE_SCHEMA = StructType([
    StructField("event_timestamp_us", LongType()), StructField("event_id", StringType()),
    StructField("pressure_psi", DoubleType()), StructField("flow_rate_lpm", DoubleType()),
    StructField("acoustic_g_rms", DoubleType()),
])


def _trailing(fn_input: pd.DataFrame, n: int) -> pd.DataFrame:
    """Trailing n-row mean / sample std and lag-1 delta over rows in order."""
    p, f, a = (fn_input[c].astype(float) for c in ("pressure_psi", "flow_rate_lpm", "acoustic_g_rms"))
    return pd.DataFrame({
        "_p_avg": p.rolling(n, min_periods=1).mean(),
        "_f_avg": f.rolling(n, min_periods=1).mean(),
        "_a_avg": a.rolling(n, min_periods=1).mean(),
        "_p_delta": p - p.shift(1),
        "_a_std": a.rolling(n, min_periods=2).std(ddof=1),
    })


def _stateful_fn(n: int, out_cols: list[str]):
    keep = n - 1

    def fn(key, chunks, state: GroupState):
        new = pd.concat(list(chunks), ignore_index=True)
        new["event_timestamp_us"] = new["event_timestamp"].astype("int64") // 1000
        new = new.sort_values(["event_timestamp_us", "event_id"], kind="mergesort")
        prev = pd.DataFrame([tuple(r) for r in state.get[0]] if state.exists else [], columns=_STATE_COLS)
        late_before = int(state.get[1] or 0) if state.exists else 0
        if len(prev):  # late = before the last kept reading in (time, event_id) order
            last_ts, last_id = prev["event_timestamp_us"].iloc[-1], prev["event_id"].iloc[-1]
            ts = new["event_timestamp_us"]
            late = (ts < last_ts) | ((ts == last_ts) & (new["event_id"] < last_id))
        else:
            late = pd.Series(False, index=new.index)
        on_time = new[~late]
        parts = [f for f in (prev.assign(_new=False), on_time.assign(_new=True)) if len(f)]
        hist = pd.concat(parts, ignore_index=True) if parts else on_time.assign(_new=True)
        emitted = pd.concat([hist, _trailing(hist, n)], axis=1)
        emitted = emitted[emitted["_new"]].drop(columns=["_new"]).assign(late=False)
        late_rows = new[late].assign(late=True, **{c: np.nan for c in RAW_FEATURES})
        out = [f for f in (emitted, late_rows) if len(f)]
        state.update((list(map(tuple, hist[_STATE_COLS].tail(keep).itertuples(index=False, name=None))),
                      late_before + int(late.sum())))
        if out:
            yield pd.concat(out, ignore_index=True)[out_cols]
    return fn


def stateful_features(stream: DataFrame, n: int = 10, eps: float = 0.0001) -> DataFrame:
    """E1-E7 on a stream of Bronze rows (quality filter first, then state),
    every cleaned row once, with ``late``."""
    clean = quality_filter(stream.select(*BRONZE_COLUMNS))
    in_schema = clean.schema
    out_schema = StructType(list(in_schema.fields) + [StructField(c, DoubleType()) for c in RAW_FEATURES]
                            + [StructField("late", BooleanType())])
    state_schema = StructType([StructField("_rows", ArrayType(STATE_SCHEMA)),
                               StructField("late", LongType())])
    raw = clean.groupBy(SEGMENT).applyInPandasWithState(
        _stateful_fn(n, [f.name for f in out_schema.fields]), out_schema, state_schema,
        "append", GroupStateTimeout.NoTimeout)
    f, a = F.col("flow_rate_lpm"), F.col("acoustic_g_rms")
    out = raw.select(
        *[f_.name for f_ in in_schema.fields], "late",
        rhu("_p_avg", 2).alias("pressure_rolling_avg"), rhu("_f_avg", 2).alias("flow_rolling_avg"),
        rhu("_a_avg", 4).alias("acoustic_rolling_avg"), rhu("_p_delta", 2).alias("pressure_delta"),
        rhu("_a_std", 4).alias("acoustic_rolling_std"))
    return out.select(
        *[f_.name for f_ in in_schema.fields], "pressure_rolling_avg", "flow_rolling_avg",
        "acoustic_rolling_avg", "pressure_delta",
        rhu(F.try_divide(f, F.col("flow_rolling_avg")), 4).alias("flow_imbalance_ratio"),
        "acoustic_rolling_std",
        rhu((a - F.col("acoustic_rolling_avg")) / (F.col("acoustic_rolling_std") + F.lit(eps)), 4)
        .alias("acoustic_zscore"), "late")


def complete(silver: DataFrame) -> DataFrame:
    """Silver rows with all features: the rows that the batch definition keeps."""
    return silver.drop("late").dropna(subset=[c for c in BATCH_FEATURES])


def run_messages_to_silver(spark: SparkSession, fmt: str, source: str, silver_path: str,
                           checkpoint: str, opts: dict | None = None,
                           max_per_trigger: int | None = None, n: int = 10,
                           wait: bool = True) -> StreamingQuery:
    """Messages -> parsed Bronze rows -> stateful Silver in one query. The rate
    cap applies to the message source (Kafka offsets keyed by segment keep each
    segment in order; files are taken in arrival order)."""
    from leakscope.streaming.bronze import bronze_stream
    rows = bronze_stream(spark, fmt, source, opts, max_per_trigger)
    out = stateful_features(rows, n).withColumn("silver_ts", F.current_timestamp())
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(silver_path))
    if wait:
        q.awaitTermination()
    return q


def late_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows per segment that arrived older than the segment's state (not
    reordered, no features), read from the stateful query's state store."""
    spark.streams  # creates the state-store coordinator in a session that ran no stream
    st = spark.read.format("statestore").load(checkpoint)
    value = F.col("value")
    vtype = st.schema["value"].dataType
    if "late" not in vtype.fieldNames():  # state of applyInPandasWithState is wrapped
        inner = vtype.fieldNames()[0]
        value = value.getField(inner)
    return st.select(F.col("key").getField(SEGMENT).alias(SEGMENT),
                     value.getField("late").alias("late_rows"))


def run_silver_stateful(spark: SparkSession, bronze_path: str, silver_path: str,
                        checkpoint: str, schema: StructType, n: int = 10,
                        max_files: int | None = None, wait: bool = True) -> StreamingQuery:
    """I7 started as an ``availableNow`` append stream into parquet.

    Ordering: the file source takes files in modification-time order, and one
    upstream Bronze batch writes several files per segment in no time order.
    A ``max_files`` cap can therefore split a batch and deliver a segment's
    earlier rows after its later ones (they are then counted as late). Leave
    it unset over a stream-written Bronze table (each trigger takes whole
    committed batches), or use ``run_messages_to_silver``, whose cap applies to
    the message source itself."""
    out = stateful_features(stream_table(spark, bronze_path, schema, max_files), n).withColumn("silver_ts", F.current_timestamp())
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(silver_path))
    if wait:
        q.awaitTermination()
    return q
