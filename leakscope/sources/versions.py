"""Whole-table replacement that is seen whole or not at all.

A table root holds ``claims/<n>`` (a version number taken by one writer),
``v<n>`` (that writer's files) and ``commits/<n>`` (the version is complete).
Numbers are taken and versions published by creating a file that must not
exist yet, which the file system does for one caller only. A reader takes the
highest committed number and stays with it; a writer that dies leaves a version
that no reader sees, and earlier versions stay whole. Files of older
versions are left to the owner's retention.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists already."""
    fs, p = _fs(spark, path)
    try:
        fs.create(p, False).close()
        return True
    except Exception:  # noqa: BLE001 - told apart below: another writer's file, or a real failure
        if fs.exists(p):
            return False
        raise


def create_with(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file with this text; it must not exist."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names(spark, path) if n.isdigit())


def claim(spark: SparkSession, root: str, first: int = 1) -> int:
    """A version number that no other writer has or gets."""
    n = max([first - 1, *numbers(spark, f"{root}/claims")]) + 1
    while not create_once(spark, f"{root}/claims/{n}"):
        n += 1
    return n


def commit(spark: SparkSession, root: str, n: int) -> None:
    if not create_once(spark, f"{root}/commits/{n}"):
        raise ValueError(f"version {n} of {root} is published already")


def current(spark: SparkSession, root: str) -> int | None:
    """The highest published version."""
    return max(numbers(spark, f"{root}/commits"), default=None)


def publish(df: DataFrame, root: str, partition_cols: list[str] | None = None) -> int:
    """``df`` as the table's next version; returns its number."""
    spark = df.sparkSession
    n = claim(spark, root)
    if partition_cols:
        df.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols).parquet(f"{root}/v{n}")
    else:
        df.write.parquet(f"{root}/v{n}")
    commit(spark, root, n)
    return n


def load_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The published version (the current one, or ``version``), pinned: later
    versions do not change what the frame reads."""
    n = current(spark, root) if version is None else version
    if n is None or n not in numbers(spark, f"{root}/commits"):
        raise FileNotFoundError(f"no published version{'' if version is None else f' {version}'} of {root}")
    return spark.read.parquet(f"{root}/v{n}")
