"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.session import scratch_path

#: Words of the substring, language-model and SimHash contracts: runs of
#: characters other than space and \x09-\x0D.
SPACE_RE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses do
    not recompute it, a lost executor loses nothing, and Spark knows the file
    size when it decides on a broadcast."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` does the same on a text without other
    upper-case letters; the rest takes 26 plain byte replacements."""
    exact = c
    for up in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        exact = F.replace(exact, F.lit(up), F.lit(up.lower()))
    other_case = c.rlike("[^\\x00-\\x7F&&[\\p{Lu}\\p{Lt}\\p{Lm}\\p{Nl}\\p{So}]]")
    return F.when(other_case, exact).otherwise(F.lower(c))


def null_safe(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Equi-join on ``key`` where null equals null; the right key is dropped."""
    r = right.withColumnRenamed(key, "_right_key")
    out = left.join(r, left[key].eqNullSafe(r["_right_key"]), how)
    return out.drop("_right_key")


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once for the row: an expression
    that a lambda merely names would be computed again for each of its elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
