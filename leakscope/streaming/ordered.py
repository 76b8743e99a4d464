"""Silver and Gold from a stream in any order of arrival.

**Reorder buffer.** A trigger's cleaned readings join the buffer of readings that
are still open. The clock is the latest event time seen (never beyond the wall
clock, so a sensor with a wrong date does not close the present); readings
older than clock - ``delay`` are closed, and leave the buffer in event-time
order with features E1-E7. The windows are the batch definition's own
(``features.batch_features``: partitions of (segment, time bucket), so a hot
segment is many tasks) over the closed readings and the last n - 1 closed ones
of each segment, which the buffer's table carries from trigger to trigger.

**Late readings.** A reading older than what is closed is not dropped and not
left without features. It and the up to n - 1 readings after it are computed
anew from the segment's neighbouring days (as many as hold n - 1 readings on
either side) and written as corrections, which replace earlier results by
(segment, time, event_id). So Silver, and Gold, equal the batch tables for
every cap, file order and delay; the delay only decides how much goes which way.

**Tables** under ``silver_path``: ``rows`` (closed in order), ``late``
(corrections) and ``state`` (buffer, tails and clock after a batch). Every batch
writes its own ``batch=`` folder, or one of two alternating state folders, with
overwrite: a batch that is replayed after a failure replaces its own output. The
state after batch k is read by batch k + 1 only. ``silver_now`` and ``gold_now``
are the tables with corrections applied.

**Scoring** (``run_gold_ordered``) takes the model version that the registry's
alias names at each trigger, and writes the version beside every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from leakscope.operators import registry
from leakscope.operators.features import ORDER, batch_features
from leakscope.operators.forest import ForestModel, score_forest
from leakscope.operators.gold import classify, gold_table
from leakscope.operators.quality import quality_filter
from leakscope.operators.windowing import epoch_micros
from leakscope.schemas import BATCH_FEATURES, BRONZE_COLUMNS, EVENT_TS, SEGMENT
from leakscope.sources.tables import stream_table

KEY = [SEGMENT, *ORDER]
DAY_US = 86_400_000_000


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _nullable(schema: StructType, names: list[str]) -> list[StructField]:
    return [StructField(n, schema[n].dataType, True) for n in names]


def silver_schema(bronze: StructType, late: bool = False) -> StructType:
    """Columns of ``rows`` (or ``late``), partition columns included."""
    extra = [StructField("arrived_late", BooleanType())] if late else []
    return StructType(_nullable(bronze, BRONZE_COLUMNS) + [StructField(c, DoubleType()) for c in BATCH_FEATURES] + extra
                      + [StructField("batch", LongType()), StructField("event_day", IntegerType())])


def state_schema(bronze: StructType) -> StructType:
    """kind: 'open' or 'tail' rows, and one 'clock' row with the numbers."""
    return StructType(_nullable(bronze, BRONZE_COLUMNS) + [
        StructField("kind", StringType()), StructField("after", LongType()), StructField("closed_us", LongType()),
        StructField("clock_us", LongType())])


class _State:
    """The buffer after step ``after``: ``open`` and ``tail`` rows,
    ``closed_us`` (readings before it are closed) and ``clock_us``. Batch k is
    step 2k and a drain after it step 2k + 1; four folders alternate."""

    def __init__(self, spark: SparkSession, silver_path: str, schema: StructType, *after: int):
        rows = spark.createDataFrame([], state_schema(schema))
        self.closed_us = self.clock_us = None
        for step in after:
            path = f"{silver_path}/state/{step % 4}"
            if self.clock_us is None and _exists(spark, f"{path}/_SUCCESS"):
                x = spark.read.schema(state_schema(schema)).parquet(path)
                clock = x.where(F.col("kind") == "clock").first()
                if clock is not None and clock["after"] == step:
                    rows, self.closed_us, self.clock_us = x, clock["closed_us"], clock["clock_us"]
        self.open, self.tail = (rows.where(F.col("kind") == k).select(*BRONZE_COLUMNS) for k in ("open", "tail"))


def _last(rows: DataFrame, n: int) -> DataFrame:
    """The last n rows of every segment (a partial limit before the shuffle)."""
    w = Window.partitionBy(SEGMENT).orderBy(*[F.col(c).desc() for c in ORDER])
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def _advance(spark: SparkSession, new: DataFrame, prev: _State, silver_path: str, step: int, delay_us: int,
             n: int, schema: StructType, everything: bool = False) -> None:
    """One step of the buffer: ``new`` cleaned readings arrive, what is closed
    now is written to ``rows``, corrections to ``late``, the rest to the state."""
    us = epoch_micros(new, EVENT_TS)
    wall = F.unix_micros(F.current_timestamp())
    seen = new.agg(F.max(F.least(us, wall))).first()[0]
    clock = max((c for c in (seen, prev.clock_us) if c is not None), default=None)
    if clock is None:
        return
    closed = max(clock - delay_us, prev.closed_us if prev.closed_us is not None else clock - delay_us)
    is_late = us < F.lit(prev.closed_us) if prev.closed_us is not None else F.lit(False)
    late, pool = new.where(is_late), prev.open.unionByName(new.where(~is_late))
    if everything:
        top = pool.agg(F.max(us)).first()[0]
        closed = max(closed, top + 1 if top is not None else closed)
    pool, ready = pool.persist(StorageLevel.MEMORY_AND_DISK), None
    try:
        ready = pool.where(us < F.lit(closed))
        tail = _last(prev.tail.unionByName(late), n - 1)
        frame = ready.withColumn("_own", F.lit(True)).unionByName(tail.withColumn("_own", F.lit(False)))
        out = batch_features(frame, n, keep_incomplete=True).where("_own").select(*BRONZE_COLUMNS, *BATCH_FEATURES)
        day = F.floor(us / DAY_US).cast("int")
        out.withColumn("event_day", day).write.mode("overwrite").partitionBy("event_day").parquet(f"{silver_path}/rows/batch={step}")
        if prev.closed_us is not None and not late.isEmpty():
            _correct(spark, late, silver_path, step, n, schema)
        kinds = [(pool.where(us >= F.lit(closed)), "open"), (_last(tail.unionByName(ready), n - 1), "tail")]
        clock_row = spark.createDataFrame([(None,) * len(BRONZE_COLUMNS) + ("clock", step, closed, clock)], state_schema(schema))
        state = clock_row
        for rows, kind in kinds:
            state = state.unionByName(rows.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
        state.hint("rebalance").write.mode("overwrite").parquet(f"{silver_path}/state/{step % 4}")
    finally:
        pool.unpersist()


def history(spark: SparkSession, silver_path: str, schema: StructType, before: int) -> DataFrame:
    """Every cleaned reading that batches before ``before`` closed, once, with
    ``event_day``."""
    out = spark.read.schema(silver_schema(schema)).parquet(f"{silver_path}/rows")
    if _exists(spark, f"{silver_path}/late"):
        late = spark.read.schema(silver_schema(schema, True)).parquet(f"{silver_path}/late").where("arrived_late")
        out = out.unionByName(late, allowMissingColumns=True)
    return out.where(F.col("batch") < before).select(*BRONZE_COLUMNS, "event_day")


def needed_days(counts: DataFrame, late_days: DataFrame, n: int) -> DataFrame:
    """(segment, event_day): days of late readings and, before and after each,
    the nearest days that hold n - 1 readings. ``counts`` has the readings per
    (segment, event_day), late days included. Works on rows of days only."""
    w = Window.partitionBy(SEGMENT).orderBy("event_day")
    c = counts.withColumn("_upto", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_before", F.col("_upto") - F.col("n"))
    marked = c.join(late_days.withColumn("_late", F.lit(True)), [SEGMENT, "event_day"], "left")
    # the nearest late day on either side decides, for a farther one asks for less
    after, ahead = w.rowsBetween(0, Window.unboundedFollowing), w.rowsBetween(Window.unboundedPreceding, 0)
    next_late = F.min(F.when(F.col("_late"), F.col("_before"))).over(after)   # readings before the next late day
    last_late = F.max(F.when(F.col("_late"), F.col("_upto"))).over(ahead)     # readings up to the last one
    near = (F.col("_late").isNotNull() | (next_late - F.col("_upto") < n - 1) | (F.col("_before") - last_late < n - 1))
    return marked.withColumn("_near", near).where("_near").select(SEGMENT, "event_day")


def _correct(spark: SparkSession, late: DataFrame, silver_path: str, batch: int, n: int, schema: StructType) -> None:
    day = F.floor(epoch_micros(late, EVENT_TS) / DAY_US).cast("int")
    late = late.withColumn("event_day", day)
    days = late.select(SEGMENT, "event_day").distinct()
    old = history(spark, silver_path, schema, batch)
    of_segments = old.join(late.select(SEGMENT).distinct(), SEGMENT, "left_semi")
    counts = (of_segments.select(SEGMENT, "event_day").withColumn("n", F.lit(1))
              .unionByName(days.withColumn("n", F.lit(0))).groupBy(SEGMENT, "event_day").agg(F.sum("n").alias("n")))
    near = old.join(needed_days(counts, days, n), [SEGMENT, "event_day"], "left_semi")
    frame = near.withColumn("arrived_late", F.lit(False)).unionByName(late.withColumn("arrived_late", F.lit(True)))
    frame = frame.drop("event_day").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        x = batch_features(frame, n, keep_incomplete=True, touched_by="arrived_late")
        tied = F.max("_touched").over(Window.partitionBy(*KEY))  # rows of one key are replaced together
        (x.withColumn("_all", tied).where("_all").withColumn("event_day", day)
         .select(*BRONZE_COLUMNS, *BATCH_FEATURES, "arrived_late", "event_day")
         .write.mode("overwrite").partitionBy("event_day").parquet(f"{silver_path}/late/batch={batch}"))
    finally:
        frame.unpersist()


def seconds(delay: str | float) -> float:
    """'10 minutes', '1 hour' or a number of seconds."""
    if not isinstance(delay, str):
        return float(delay)
    number, unit = delay.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def run_silver_ordered(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str,
                       schema: StructType, delay: str | float = "1 hour", n: int = 10,
                       max_files: int | None = None, drain: bool = True) -> StreamingQuery:
    """Drain what is available. With ``drain`` the buffer is closed afterwards,
    so that Silver has every reading; a later run takes up from there."""
    delay_us = int(seconds(delay) * 1_000_000)
    last = {}

    def process(batch: DataFrame, k: int) -> None:
        s = batch.sparkSession
        new = quality_filter(batch.select(*BRONZE_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            prev = _State(s, silver_path, schema, 2 * k - 1, 2 * k - 2)
            _advance(s, new, prev, silver_path, 2 * k, delay_us, n, schema)
        finally:
            new.unpersist()
        last["batch"] = k

    q = (stream_table(spark, bronze_path, schema, max_files).writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if drain and "batch" in last:
        drain_silver(spark, silver_path, schema, last["batch"], n)
    return q


def drain_silver(spark: SparkSession, silver_path: str, schema: StructType, batch: int, n: int = 10) -> None:
    """Close the buffer after ``batch``. Repeating it is harmless."""
    nothing = spark.createDataFrame([], StructType(_nullable(schema, BRONZE_COLUMNS)))
    _advance(spark, nothing, _State(spark, silver_path, schema, 2 * batch), silver_path, 2 * batch + 1, 0, n, schema, True)


def _latest(corrections: DataFrame) -> DataFrame:
    w = Window.partitionBy(*KEY).orderBy(F.desc("batch"))
    return corrections.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


def silver_now(spark: SparkSession, silver_path: str, schema: StructType) -> DataFrame:
    """Silver with corrections applied: the batch definition's rows of all
    closed readings."""
    rows = spark.read.schema(silver_schema(schema)).parquet(f"{silver_path}/rows").select(*BRONZE_COLUMNS, *BATCH_FEATURES)
    if _exists(spark, f"{silver_path}/late"):
        late = spark.read.schema(silver_schema(schema, True)).parquet(f"{silver_path}/late")
        rows = (rows.join(late.select(*KEY).distinct(), KEY, "left_anti")
                .unionByName(_latest(late).select(rows.columns)))
    return rows.dropna()


ModelSource = Callable[[], tuple[int | None, ForestModel]]


def production_model(spark: SparkSession, root: str, name: str, alias: str | None = None) -> ModelSource:
    """The model that ``alias`` names (default: production, else the latest) at
    the time of the call. A version is loaded once; only the alias is read
    at every call."""
    loaded: dict[int, ForestModel] = {}

    def now():
        v = registry.resolve(spark, root, name, alias)
        if v not in loaded:
            loaded.clear()
            loaded[v] = registry.load(spark, root, name, v)
        return v, loaded[v]
    return now


def run_gold_ordered(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str, schema: StructType,
                     model: ModelSource | ForestModel, cut: float = -0.07, max_files: int | None = None) -> list[StreamingQuery]:
    """Score Silver's ``rows`` and ``late`` tables as streams into ``gold_path``
    (folders of the same names). Each trigger asks ``model`` for the model and
    writes ``model_version`` and ``silver_batch`` with the rows, under the
    trigger's own folder (a replay overwrites it)."""
    source = model if callable(model) else lambda: (None, model)

    def scorer(out: str):
        def process(batch: DataFrame, k: int) -> None:
            version, forest = source()
            g = gold_table(classify(score_forest(batch.dropna(subset=BATCH_FEATURES), forest), cut=cut),
                           extra=[F.lit(version).cast("int").alias("model_version"), F.col("batch").alias("silver_batch")])
            (g.hint("rebalance", SEGMENT, "severity").write.mode("overwrite").partitionBy(SEGMENT, "severity")
             .parquet(f"{out}/trigger={k}"))
        return process

    queries = []
    for name in ("rows", "late"):
        if _exists(spark, f"{silver_path}/{name}"):
            rows = stream_table(spark, f"{silver_path}/{name}", silver_schema(schema, name == "late"), max_files)
            q = (rows.writeStream.foreachBatch(scorer(f"{gold_path}/{name}"))
                 .option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
            q.awaitTermination()
            queries.append(q)
    return queries


def gold_now(spark: SparkSession, silver_path: str, gold_path: str, schema: StructType) -> DataFrame:
    """Gold with corrections applied."""
    rows = spark.read.parquet(f"{gold_path}/rows").drop("trigger")
    if not _exists(spark, f"{silver_path}/late"):
        return rows
    last = _latest(spark.read.schema(silver_schema(schema, True)).parquet(f"{silver_path}/late")).select(
        *KEY, F.col("batch").alias("silver_batch")).distinct()
    out = rows.join(last.select(*KEY), KEY, "left_anti")
    if _exists(spark, f"{gold_path}/late"):
        late = spark.read.parquet(f"{gold_path}/late").drop("trigger")
        out = out.unionByName(late.join(last, [*KEY, "silver_batch"], "left_semi").select(rows.columns))
    return out
