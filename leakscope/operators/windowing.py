"""Exact trailing-row windows that do not put a whole segment in one task.

A window ``PARTITION BY segment ORDER BY time ROWS n PRECEDING`` runs each
segment in one task: with a handful of segments, one of them holding a third of
100 TB, that is neither parallel nor able to fit in memory. Here every segment
is cut into buckets of neighbouring rows and each bucket is sent, together with
the ``halo`` rows that precede it in the segment, to its own window partition
``(segment, bucket)``. Frames reaching back at most ``halo`` rows are then
exact for the bucket's own rows; the halo copies are dropped afterwards.

How the halo rows are found without ranking the whole segment:

1. ``counts``: rows per (segment, bucket) and their running total ``_cum``
   (offset ``_off`` = rows before the bucket). One small aggregate plus a
   window over that small table.
2. ``tail``: the last ``halo`` rows of every bucket. The same aggregate counts
   the rows of a bucket's slices (equal shares of its span, some 100 rows
   each), so the slices that hold the last ``halo`` rows are known, and only
   their rows are sorted. A tail row's position in its segment is
   ``_cum - rank_from_end + 1``.
3. A row at position ``o`` is needed by the later bucket whose offset lies in
   ``[o, o + halo - 1]``: explode those ``halo`` candidate offsets and equi-join
   them to ``counts`` (offsets are unique per segment). Sparse buckets, which
   need rows from several earlier buckets, come out right by the same rule.

The big input is shuffled once (by the caller's window); the extra work is
aggregates over narrow columns and joins with small tables.

Buckets: fixed (``bucket_seconds``) or, by default, planned so that a bucket
holds about ``target_rows`` rows. The plan refines overfull buckets level by
level. A bucket that is too large gets its own start and width, taken from the
smallest and largest value of its first varying dimension: time in
microseconds, then the tie-breaking id, seven bytes at a time. One stray time
costs one level, a burst within a microsecond is cut by id, and rows without a
time (which sort first) are cut by id as well. A bucket number is the path of
cell numbers, whose order is the row order. Each level is a table of (segment,
path) with one row for each refined bucket; the join to it is broadcast only if
Spark finds the table small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from leakscope.operators.lineage import as_table

NULL_TIME = -(2 ** 61)          # sorts before every time, as NULL does
DEFAULT_BUCKET_SECONDS = None   # None: planned buckets
TARGET_ROWS = 100_000           # rows per (key, bucket) window partition: small, so that few keys make many tasks
SLACK = 1.5                     # a bucket is refined beyond this many targets
ID_CHUNKS = 6                   # times seven bytes of the id that can be told apart
MAX_LEVELS = 16
SLICE_ROWS = 100                # rows that a bucket's slice holds if they are spread evenly
MAX_SLICES = 1024
UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Seconds since 1970 of a timestamp column: wall clock for NTZ, instant
    for LTZ (monotone in the column's own order either way)."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        c = F.col(ts)  # wall-clock arithmetic only: no zone, no DST jumps
        return (F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600
                + F.minute(c) * 60 + F.second(c))
    return F.unix_seconds(F.col(ts))


def epoch_micros(df: DataFrame, ts: str) -> Column:
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC:  # no jumps: each wall clock is one instant
            return F.unix_micros(F.col(ts).cast("timestamp"))
        # a difference of two wall clocks: no zone either, and one step instead of a part at a time
        since = F.col(ts) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        return (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("bigint")
    return F.unix_micros(F.col(ts))


def dimensions(df: DataFrame, ts: str, tie: str) -> list[Column]:
    """Numbers whose order, one after the other, is the (ts, tie) row order."""
    raw = F.col(tie).cast("string").cast("binary")
    out = [F.coalesce(epoch_micros(df, ts), F.lit(NULL_TIME))]
    for i in range(ID_CHUNKS):
        part = F.rpad(F.hex(F.substring(raw, 7 * i + 1, 7)), 14, "0")
        out.append(F.coalesce(F.conv(part, 16, 10).cast("bigint"), F.lit(-1)))
    return out


def plan_buckets(df: DataFrame, key: str, ts: str, tie: str,
                 target_rows: int = TARGET_ROWS) -> list[DataFrame]:
    """Levels of (key, path, dim, lo, width): the refined buckets. The plan only
    steers partitioning (results do not depend on it), so it may come from a
    cheaper frame than the one windowed, e.g. the raw table's key, time and id.
    The id is looked at only where time alone cannot cut a bucket."""
    dims = dimensions(df, ts, tie)
    x = df.select(F.col(key), F.col(ts), F.col(tie), F.col(key).alias("_k"), F.array().cast("array<bigint>").alias("_path"))
    levels: list[DataFrame] = []
    seen = 1  # dimensions looked at so far
    while len(levels) < MAX_LEVELS:
        ends = [e for i, d in enumerate(dims[:seen]) for e in (F.min(d).alias(f"_lo{i}"), F.max(d).alias(f"_hi{i}"))]
        full = (x.groupBy("_k", "_path").agg(F.count(F.lit(1)).alias("_n"), *ends)
                .where(F.col("_n") > F.lit(SLACK * target_rows)))
        dim, lo, span = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("double")
        for i in reversed(range(seen)):
            low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
            dim = F.when(low < high, F.lit(i + 1)).otherwise(dim)
            lo = F.when(low < high, low).otherwise(lo)
            span = F.when(low < high, high.cast("double") - low + 1).otherwise(span)
        width = F.greatest(F.lit(1.0), F.ceil(span * target_rows / F.col("_n")).cast("double"))
        full = as_table(full.select("_k", "_path", dim.alias("_dim"), lo.alias("_lo"), width.alias("_w")), "buckets")
        last, some = full.agg(F.max("_dim"), F.count(F.lit(1))).first()
        if last is not None:
            levels.append(full.where("_dim IS NOT NULL"))
            x = _refine(x, levels[-1], dims[:last])
        elif seen < len(dims) and some:
            seen += 1
        else:
            break
    return levels


def _refine(x: DataFrame, level: DataFrame, dims: list[Column], slices: int = 0) -> DataFrame:
    """Appends each row's cell number to its path (0 where not refined).
    ``dims``: those that the level cuts, mostly the time alone (the id's are costly).
    With ``slices``, a refined row's ``_slice`` is its place within the cell,
    in row order too, as dimensions before the one cut do not vary there."""
    lv = level.select(F.col("_k").alias("_lk"), F.col("_path").alias("_lp"), "_dim", "_lo", "_w")
    value = F.lit(None).cast("bigint")
    for i, d in enumerate(dims):
        value = F.when(F.col("_dim") == i + 1, d).otherwise(value)
    at = (value - F.col("_lo")) / F.col("_w")
    cell = F.coalesce(F.floor(at).cast("bigint"), F.lit(0))
    x = x.join(lv, x["_k"].eqNullSafe(lv["_lk"]) & (x["_path"] == lv["_lp"]), "left")
    if slices:
        x = x.withColumn("_slice", F.coalesce(F.floor((at - F.floor(at)) * slices).cast("int"), F.col("_slice")))
    return (x.withColumn("_path", F.concat("_path", F.array(cell)))
            .drop("_lk", "_lp", "_dim", "_lo", "_w"))


def with_bucket(df: DataFrame, key: str, ts: str, tie: str, seconds: int | None = None,
                target_rows: int = TARGET_ROWS, plan: list[DataFrame] | None = None, slices: int = 0) -> DataFrame:
    """``df`` with ``_b``, the bucket path, monotone in (ts, tie) within a key;
    with ``slices`` also with ``_slice``, monotone within a bucket."""
    if slices:
        df = df.withColumn("_slice", F.lit(0))
    if seconds is not None:
        b = F.coalesce(F.floor(epoch_seconds(df, ts) / F.lit(seconds)).cast("bigint"), F.lit(NULL_TIME))
        return df.withColumn("_b", F.array(b))
    levels = plan_buckets(df, key, ts, tie, target_rows) if plan is None else plan
    x = df.withColumn("_k", F.col(key)).withColumn("_path", F.array().cast("array<bigint>"))
    for level in levels:
        used = level.agg(F.max("_dim")).first()[0] or 0
        x = _refine(x, level, dimensions(df, ts, tie)[:used], slices)
    return x.withColumnRenamed("_path", "_b").drop("_k")


def bucket_counts(df: DataFrame, key: str, bucket: str = "_b") -> DataFrame:
    """(key, bucket, _n, _off, _cum): rows per bucket and their offsets."""
    return _with_offsets(df.groupBy(key, bucket).agg(F.count(F.lit(1)).alias("_n")), key, bucket)


def _with_offsets(sizes: DataFrame, key: str, bucket: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return (sizes.withColumn("_cum", F.sum("_n").over(w))
            .withColumn("_off", F.col("_cum") - F.col("_n")))


def with_halo(df: DataFrame, key: str, order: list[str], ts: str, halo: int,
              bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
              target_rows: int = TARGET_ROWS, plan: list[DataFrame] | None = None) -> DataFrame:
    """All rows of ``df`` tagged ``_chunk`` (their bucket) and ``_halo = false``,
    plus copies of the up to ``halo`` rows preceding each bucket tagged with
    that bucket and ``_halo = true``.

    Windows over ``partitionBy(key, "_chunk").orderBy(*order)`` whose frame
    reaches back at most ``halo`` rows are exact for ``_halo = false`` rows.
    ``order`` must be ``[ts, tie]`` and a total order within a key.
    """
    cols = df.columns
    slices = max(1, min(MAX_SLICES, target_rows // SLICE_ROWS))
    x = with_bucket(df, key, ts, order[-1], bucket_seconds, target_rows, plan, slices)
    main = x.withColumn("_chunk", F.col("_b")).withColumn("_halo", F.lit(False)).drop("_b", "_slice")
    if halo <= 0:
        return main
    # written: small, and Spark knows it, so that the rows stay where they are
    sizes = as_table(x.groupBy(key, "_b", "_slice").agg(F.count(F.lit(1)).alias("_n")), "slices")
    later = Window.partitionBy(key, "_b").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    last = F.coalesce(F.sum("_n").over(later), F.lit(0)) < halo
    per_bucket = as_table(sizes.withColumn("_last", last).groupBy(key, "_b")
                          .agg(F.sum("_n").alias("_n"), F.min(F.when(F.col("_last"), F.col("_slice"))).alias("_from")), "counts")
    counts = _with_offsets(per_bucket, key, "_b")
    w_end = Window.partitionBy(key, "_b").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tail = (x.join(counts.select(key, "_b", "_cum", "_from"), [key, "_b"]).where(F.col("_slice") >= F.col("_from"))
            .withColumn("_rd", F.row_number().over(w_end)).where(F.col("_rd") <= halo)
            .withColumn("_pos", F.col("_cum") - F.col("_rd") + 1)
            .withColumn("_target", F.explode(F.sequence(F.col("_pos"),
                                                        F.col("_pos") + (halo - 1)))))
    # every bucket has a ``_from``: asking for it here too gives both readers of the counts one exchange
    targets = counts.where(F.col("_from").isNotNull()).select(F.col(key).alias("_k"), F.col("_off").alias("_target"),
                                                              F.col("_b").alias("_chunk"))
    halo_rows = (tail.join(targets, (tail[key] == targets["_k"]) &
                           (tail["_target"] == targets["_target"]))
                 .select(*[tail[c] for c in cols], targets["_chunk"],
                         F.lit(True).alias("_halo")))
    return main.unionByName(halo_rows)


def chunk_window(key: str, order: list[str]) -> Window:
    return Window.partitionBy(key, "_chunk").orderBy(*order)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop("_chunk", "_halo")
