"""Exact global row numbers without a single-task window.

``row_number() OVER (ORDER BY ...)`` sends all rows to one task. Here the rows
are range-partitioned by the keys (sampled bounds), sorted within partitions
and numbered from zero in each; one count per partition gives the partition's
offset. The offsets are one row a partition, so the join to them is a broadcast
of a size that the number of partitions bounds.

Rows that tie in all keys are dealt over partitions by a random last key, so a
key value that a third of the rows share is no single task. Which of them comes
first is then open: give keys that tell rows apart where it matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.operators.lineage import as_table

INDEX_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def _nulls_first(key: str | Column) -> Column:
    return F.col(key).asc_nulls_first() if isinstance(key, str) else key


def range_sorted(df: DataFrame, *keys: str | Column, partitions: int | None = None) -> DataFrame:
    """``df`` in global order: partition k's rows all sort before partition k+1's.
    Equal rows are spread by a random last key."""
    order = [_nulls_first(k) for k in keys]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = df.withColumn("_tie", F.rand(7))
    return x.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")


def with_position(df: DataFrame, *keys: str | Column, name: str = "position",
                  partitions: int | None = None) -> DataFrame:
    """``df`` with the 1-based position of each row in the order of ``keys``
    (names sort ascending, null first; pass columns for other directions).
    The sorted rows are written once, so that a lost executor cannot number
    them anew."""
    ranged = as_table(range_sorted(df, *keys, partitions=partitions)
                      .withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", INDEX_BITS)
    counts = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select(F.col("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    index = F.col("_at").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    return (ranged.withColumn("_p", part).join(F.broadcast(offsets), "_p")
            .withColumn(name, F.col("_before") + index + 1).drop("_p", "_at", "_before"))


def with_position_in_group(df: DataFrame, group: str, *keys: str | Column, name: str = "position") -> DataFrame:
    """``df`` with each row's 1-based position within its ``group`` (not null):
    the global position less that of the group's first row. A group may be
    spread over many tasks; the join back has one row a group on one side."""
    x = as_table(with_position(df, group, *keys, name="_global"), "positions")
    first = x.groupBy(F.col(group).alias("_g")).agg(F.min("_global").alias("_first"))
    return (x.join(first, F.col(group) == F.col("_g"))
            .withColumn(name, F.col("_global") - F.col("_first") + 1).drop("_g", "_first", "_global"))
