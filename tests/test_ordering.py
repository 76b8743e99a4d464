"""Global positions by range partitions."""

import pytest
from pyspark.sql import functions as F

from leakscope.operators.ordering import range_sorted, with_position, with_position_in_group


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_position_is_row_number(spark, parts):
    rows = [((i * 37) % 1000 if i % 11 else None, f"k{i:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = {r["b"]: r["position"] for r in with_position(df, "a", "b", partitions=parts).collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {b: i + 1 for i, (_, b) in enumerate(want)}
    down = {r["b"]: r["position"] for r in with_position(df, F.desc_nulls_last("a"), F.asc("b"), partitions=parts).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert down == {b: i + 1 for i, (_, b) in enumerate(want)}


def test_one_key_is_many_tasks(spark):
    df = spark.range(40_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    sizes = [r["count"] for r in range_sorted(df, "a", "b", partitions=8)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 12_000     # equal rows are spread
    got = with_position(df, "a", "b", partitions=8).agg(F.count_distinct("position"), F.min("position"), F.max("position")).first()
    assert tuple(got) == (40_000, 1, 40_000)


def test_position_in_group(spark):
    rows = [(g, i * 7 % 50) for g in range(4) for i in range(50 if g else 3000)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(6)
    got = with_position_in_group(df, "g", "v")
    assert got.where("g > 0 AND position <> v + 1").count() == 0
    assert sorted(r[0] for r in got.where("g = 0").select("position").collect()) == list(range(1, 3001))
    assert with_position(df.where("g = 9"), "g").collect() == []
