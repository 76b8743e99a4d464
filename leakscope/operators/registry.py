"""J10 (re-aimed): versioned model store on plain parquet.

Layout under ``root``: ``<name>/v<version>/`` holds the model tables and a
one-row ``meta`` table, which is written last; a version number is claimed by
one writer (``<name>/claims``); ``<name>/aliases`` is an append-only log of (alias,
version, number), of which the highest number counts. Resolving "production" =
the aliased version, else the latest version. Models here are
Spark tables (forest node table, scaler rows) or MLlib models, so loading never
depends on a driver-side pickle.
"""

from __future__ import annotations

import json
import os

from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leakscope.operators.forest import ForestModel
from leakscope.operators.sequence import SequenceModel
from leakscope.sources.versions import claim, names


ALIAS_SCHEMA = "alias string, version int, number long"


def _versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Complete versions: ``meta`` is written last."""
    d = os.path.join(root, name)
    found = sorted(int(n[1:]) for n in names(spark, d) if n.startswith("v") and n[1:].isdigit())
    return [v for v in found if "_SUCCESS" in names(spark, os.path.join(d, f"v{v}", "meta"))]


def _claim(spark: SparkSession, root: str, name: str) -> int:
    """The next version number, for this writer alone."""
    d = os.path.join(root, name)
    taken = [int(n[1:]) for n in names(spark, d) if n.startswith("v") and n[1:].isdigit()]
    return claim(spark, d, max(taken, default=0) + 1)


def _meta(spark, d: str, payload: dict):
    spark.range(1).select(F.lit(json.dumps(payload)).alias("meta")).write.mode("overwrite") \
        .parquet(os.path.join(d, "meta"))


def save_forest(spark: SparkSession, root: str, name: str, model: ForestModel,
                alias: str | None = None) -> int:
    """Write version n + 1 and optionally point ``alias`` at it."""
    v = _claim(spark, root, name)
    d = os.path.join(root, name, f"v{v}")
    model.nodes.write.mode("overwrite").parquet(os.path.join(d, "nodes"))
    _meta(spark, d, {"kind": "forest", "cols": model.cols, "psi": model.psi, "trees": model.trees,
                     "seed": model.seed, "offset": model.offset,
                     "contamination": model.contamination,
                     "scaler": {k: list(v_) for k, v_ in model.scaler.items()}})
    if alias:
        set_alias(spark, root, name, alias, v)
    return v


def save_sequence(spark: SparkSession, root: str, name: str, model: SequenceModel,
                  alias: str | None = None) -> int:
    v = _claim(spark, root, name)
    d = os.path.join(root, name, f"v{v}")
    model.mlp.write().overwrite().save(os.path.join(d, "mlp"))
    _meta(spark, d, {"kind": "sequence", "cols": model.cols, "n": model.n,
                     "threshold": model.threshold, "scaler": model.scaler})
    if alias:
        set_alias(spark, root, name, alias, v)
    return v


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _alias_log(spark: SparkSession, root: str, name: str):
    p = os.path.join(root, name, "aliases")
    return spark.read.schema(ALIAS_SCHEMA).parquet(p) if _exists(spark, p) else None


def set_alias(spark: SparkSession, root: str, name: str, alias: str, version: int) -> None:
    """Point ``alias`` at ``version``: one appended row; an error leaves the log
    as it was."""
    log = _alias_log(spark, root, name)
    last = log.agg(F.max("number")).first()[0] if log is not None else None
    (spark.range(1).select(F.lit(alias).alias("alias"), F.lit(version).alias("version"),
                           F.lit((last or 0) + 1).cast("long").alias("number"))
     .write.mode("append").parquet(os.path.join(root, name, "aliases")))


def resolve(spark: SparkSession, root: str, name: str, version_or_alias=None) -> int:
    """Version number for an int, an alias, or None (= 'production' if set, else latest)."""
    if isinstance(version_or_alias, int):
        return version_or_alias
    alias = version_or_alias or "production"
    log = _alias_log(spark, root, name)
    if log is not None:
        hit = log.where(F.col("alias") == alias).orderBy(F.desc("number")).first()
        if hit is not None:
            return int(hit.version)
    if version_or_alias is not None:
        raise KeyError(f"unknown alias {alias!r} for {name}")
    vs = _versions(spark, root, name)
    if not vs:
        raise KeyError(f"no versions of {name}")
    return vs[-1]


def load(spark: SparkSession, root: str, name: str, version_or_alias=None):
    v = resolve(spark, root, name, version_or_alias)
    d = os.path.join(root, name, f"v{v}")
    meta = json.loads(spark.read.parquet(os.path.join(d, "meta")).first()["meta"])
    if meta["kind"] == "forest":
        return ForestModel(spark.read.parquet(os.path.join(d, "nodes")), meta["cols"], meta["psi"],
                           meta["trees"], meta["seed"], meta["offset"], meta["contamination"],
                           {k: tuple(v_) for k, v_ in meta["scaler"].items()})
    mlp = MultilayerPerceptronClassificationModel.load(os.path.join(d, "mlp"))
    return SequenceModel(mlp, meta["scaler"], meta["cols"], meta["n"], meta["threshold"])
