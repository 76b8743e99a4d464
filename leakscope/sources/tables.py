"""Table reads, writes, DDL and the layer audit.

Tables are parquet directories (or catalog tables when a name without '/' is
given). Writers rebalance on the partition columns first, so each output
partition is written by a few tasks instead of every task (no small files), and
adaptive execution splits a large partition value over as many tasks as it
needs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _is_path(t: str) -> bool:
    return "/" in t or t.startswith("file:")


def load(spark: SparkSession, name: str, merge_schema: bool = False) -> DataFrame:
    """A4: static scan of a table name or parquet path."""
    if _is_path(name):
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(name)
    return spark.table(name)


def stream_table(spark: SparkSession, path: str, schema: StructType,
                 max_files: int | None = None) -> DataFrame:
    """A3: an append-only parquet table read as a stream."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _writer(df: DataFrame, mode: str, partition_cols):
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
        return df.write.mode(mode).partitionBy(*partition_cols)
    return df.write.mode(mode)


def append(df: DataFrame, table: str, partition_cols=None) -> None:
    """A6."""
    w = _writer(df, "append", partition_cols)
    w.parquet(table) if _is_path(table) else w.saveAsTable(table)


def replace(df: DataFrame, table: str, partition_cols=None) -> None:
    """A7 (+A8): full overwrite, schema replaced. Columns such as ``gold_ts``
    are added before this single write instead of rewriting the table."""
    w = _writer(df, "overwrite", partition_cols)
    w.parquet(table) if _is_path(table) else w.saveAsTable(table)


WIDER = {"tinyint": ["smallint", "int", "bigint", "float", "double"], "smallint": ["int", "bigint", "float", "double"],
         "int": ["bigint", "double"], "bigint": [], "float": ["double"], "date": ["timestamp_ntz"]}


def append_evolving(df: DataFrame, table: str, partition_cols=None) -> None:
    """Append rows whose schema may add columns. For a path, readers use
    ``load(..., merge_schema=True)`` to see the union of columns. A named
    table gets the new columns first (old rows read as NULL); a column that is
    narrower than the table's is widened where no value changes, a column that
    the rows lack is NULL, and one that would have to be narrowed is refused
    before anything is written."""
    if _is_path(table):
        _writer(df, "append", partition_cols).parquet(table)
        return
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _writer(df, "overwrite", partition_cols).saveAsTable(table)
        return
    have, own = dict(spark.table(table).dtypes), dict(df.dtypes)
    low = {c.lower(): c for c in have}
    same = {c: low.get(c.lower()) for c in df.columns}
    for c, t in same.items():
        if t and own[c] != have[t] and have[t] not in WIDER.get(own[c], []):
            raise ValueError(f"column {c}: {own[c]} does not fit into {have[t]} of {table} without loss")
    new = [c for c, t in same.items() if t is None]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {own[c]}' for c in new)})")
    back = {t: c for c, t in same.items() if t}
    cols = [F.col(f"`{back.get(c, c)}`").cast(t).alias(c) if back.get(c, c) in own else F.lit(None).cast(t).alias(c)
            for c, t in spark.table(table).dtypes]
    out = df.select(*cols)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    (out.hint("rebalance", *parts) if parts else out).write.insertInto(table)


def bootstrap(spark: SparkSession, db: str) -> None:
    """Schema (database) for the layer tables."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{db}`")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{db}`")


def audit(specs: list[tuple[str, DataFrame | None, str]]) -> DataFrame:
    """Per (table name, frame, timestamp column): records, latest, status.
    A missing table or column is reported in ``status``, never raised."""
    parts = []
    for name, df, ts in specs:
        if df is None:
            raise ValueError("audit needs at least the frames that exist")
        if ts in df.columns:
            p = df.agg(F.count(F.lit(1)).alias("records"),
                       F.max(ts).cast("timestamp_ntz").alias("latest"))
            status = F.lit("ok")
        else:
            p = df.agg(F.count(F.lit(1)).alias("records"),
                       F.lit(None).cast("timestamp_ntz").alias("latest"))
            status = F.lit(f"missing column {ts}")
        parts.append(p.select(F.lit(name).alias("table_name"), "records", "latest",
                              status.alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_audit(spark: SparkSession, specs: list[tuple[str, str]]) -> DataFrame:
    """A13 on stored tables: (table or path, timestamp column) pairs; a table
    that does not exist gets status 'missing table'."""
    frames = []
    for t, ts in specs:
        try:
            df = load(spark, t)
        except AnalysisException as e:  # other failures (no permission, broken files) are the caller's to see
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            frames.append(spark.range(1).select(
                F.lit(t).alias("table_name"), F.lit(0).cast("bigint").alias("records"),
                F.lit(None).cast("timestamp_ntz").alias("latest"),
                F.lit("missing table").alias("status")))
            continue
        frames.append(audit([(t, df, ts)]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, written by the executors (no driver round-trip)."""
    df.write.mode("overwrite").option("header", True).csv(path)
