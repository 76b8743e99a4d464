"""Stratified split, standardisation, isolation forest fit and score.

Isolation forest (Liu, Ting, Zhou 2008):
* each tree sees psi rows drawn without replacement; trees are grown by random
  feature / random threshold splits up to depth ceil(log2 psi);
* path length of a row = depth of its leaf + c(leaf size), with
  c(n) = 2 (ln(n - 1) + Euler gamma) - 2 (n - 1) / n, c(2) = 1, c(<=1) = 0;
* raw score = -2 ** (-mean path / c(psi)); offset = the contamination quantile
  of raw scores on the training rows; anomaly_score = raw - offset (< 0 means
  anomaly).

Spark layout: sampling is a hash draw + per-tree top-psi (partial
WindowGroupLimit), all trees grow together level by level as windows over
(tree, node), the model is a node table with a proven size bound
(trees x (2 ** (depth + 1) - 1) rows), and scoring is a vectorised
``pandas_udf`` that carries the node arrays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StructField, StructType)

from leakscope.operators.gold import prediction_from_score
from leakscope.operators.lineage import as_table, materialize
from leakscope.operators.selection import exact_quantile, smallest_per_group
from leakscope.schemas import EVENT_ID, FOREST_FEATURES
from leakscope.session import parallelism

EULER_GAMMA = 0.5772156649015329


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out = np.where(n == 2, 1.0, out)
    big = n > 2
    nb = np.where(big, n, 3.0)
    out = np.where(big, 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb, out)
    return out


# ---------------------------------------------------------------- hashes
HASH_BITS = 52


def hash52(*parts) -> F.Column:
    """The first 13 hexadecimal digits of md5 over the parts joined by ':', as
    a number: any engine that has md5 draws the same rows."""
    text = F.concat_ws(":", *[p if isinstance(p, F.Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


# ---------------------------------------------------------------- J1 split
def stratified_split(df: DataFrame, label: str, frac: float = 0.2, seed: int = 42,
                     key: str = EVENT_ID, rows_per_cell: int = 100_000) -> DataFrame:
    """Adds ``split`` = 'test' for exactly ceil(frac * n_c) rows of every class c
    (those with the smallest hash52(seed, key), ties by key), else 'train'.
    Independent of partitioning; no window over a whole class; any number of
    classes (the edges are a table that is joined)."""
    x = df.withColumn("_h", hash52(seed, F.col(key).cast("string")))
    edges = as_table(smallest_per_group(x, label, "_h", key, frac, rows_per_cell)
                     .withColumnRenamed(label, "_label"), "split-edges")
    j = x.join(edges, x[label].eqNullSafe(edges["_label"]), "left")
    test = F.struct(F.col("_h").alias("v"), F.col(key).alias("k")) <= F.col("edge")
    return (j.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))
            .drop("_h", "_label", "edge"))


# ---------------------------------------------------------------- J2 scaling
def fit_standard_scaler(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std per column (one partial aggregate, one row back)."""
    r = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
               *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (r[f"m_{c}"], r[f"s_{c}"]) for c in cols}


def standardise(df: DataFrame, stats: dict, cols: list[str] | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / std, dividing by 1 where the std is 0 (as the usual scaler)."""
    cols = cols or list(stats)
    out = {}
    for c in cols:
        m, s = stats[c]
        s = 1.0 if (s is None or s == 0 or math.isnan(s)) else s
        out[c + suffix] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


# ---------------------------------------------------------------- J3 sampling
def tree_samples(df: DataFrame, cols: list[str], trees: int, psi: int, seed: int,
                 key: str = EVENT_ID, oversample: float = 3.0) -> tuple[DataFrame, int]:
    """Rows (tree, key, *cols): for every tree psi_eff = min(psi, n) rows.

    One definition for all sizes: every (row, tree) pair is a candidate with
    chance p = min(1, oversample * psi / n), and of its candidates a tree takes
    the psi_eff with the smallest hash52(seed, tree, key). A row's candidate
    trees come from hashes of the row alone. The number of trees before its
    first is geometric, so one hash decides it, and the trees after the first
    are drawn one by one, which only the few rows that have a first tree pay.
    The top psi of a tree is a partial WindowGroupLimit."""
    base = df.select(F.col(key).cast("string").alias(key), *cols)
    n = base.count()
    psi_eff = min(psi, n)
    if psi_eff == 0:
        raise ValueError("cannot fit a forest on an empty frame")
    unit = float(1 << HASH_BITS)
    while True:
        p = min(1.0, oversample * psi_eff / n)
        if p < 1.0:
            u = hash52(seed, "first", F.col(key)) / F.lit(unit)
            first = F.floor(F.log(1 - u) / F.lit(math.log1p(-p))).cast("int")
            rest = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: (t > F.col("_first")) & (
                hash52(seed, "next", t.cast("string"), F.col(key)) < F.lit(p * unit)))
            picked = (base.withColumn("_first", first).where(F.col("_first") < trees)
                      .withColumn("tree", F.explode(F.concat(F.array("_first"), rest))).drop("_first"))
        else:
            picked = base.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        cand = picked.withColumn("_h", hash52(seed, F.col("tree").cast("string"), F.col(key)))
        w = Window.partitionBy("tree").orderBy("_h", key)
        sample = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi_eff)
        sample = materialize(sample.drop("_r", "_h"))  # trees x psi rows
        full = sample.groupBy("tree").count().where(F.col("count") == psi_eff).count()
        if full == trees or p >= 1.0:
            return sample, psi_eff
        oversample *= 2


# ---------------------------------------------------------------- J3 fitting
NODE_SCHEMA = StructType([
    StructField("tree", IntegerType(), False), StructField("node", IntegerType(), False),
    StructField("feature", IntegerType(), False), StructField("threshold", DoubleType(), True),
    StructField("left", IntegerType(), False), StructField("right", IntegerType(), False),
    StructField("size", LongType(), False), StructField("depth", IntegerType(), False),
    StructField("path", DoubleType(), True),
])


PATH_UNIT = float(1 << 32)  # path lengths are multiples of 1 / PATH_UNIT: their sums do not depend on order
NODE = "struct<node:int,feature:int,threshold:double,size:bigint,depth:int>"


def _c_expr(size: F.Column) -> F.Column:
    """``c_factor`` of a column."""
    n = F.greatest(size, F.lit(3)).cast("double")
    c = 2.0 * (F.log(n - 1.0) + F.lit(EULER_GAMMA)) - 2.0 * (n - 1.0) / n
    return F.when(size > 2, c).when(size == 2, 1.0).otherwise(0.0)


def _feature_draw(tree: F.Column, node: F.Column, seed: int, i: int) -> F.Column:
    """Four hexadecimal digits that rank feature ``i`` in (tree, node)."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(f"feature{i // 8}"), tree.cast("string"), node.cast("string")))
    return F.substring(text, 4 * (i % 8) + 1, 4)


def grow_by_levels(sample: DataFrame, cols: list[str], seed: int, max_depth: int) -> DataFrame:
    """NODE_SCHEMA rows of all trees at once, level by level.

    At each level the rows of a (tree, node) give its size and every feature's
    smallest and largest value. Of the features that vary, the one with the
    smallest hash splits, at lo + u (hi - lo) with u a hash of (tree, node) too;
    rows below go to node 2 k + 1, the others to 2 k + 2. A node of one row,
    without a feature that varies, or at ``max_depth`` is a leaf. Hashes are
    md5, so any engine grows the same trees from the same sample.

    All levels are windows over (tree, node) of rows that are dealt by tree
    once: a window holds at most psi rows, and no level shuffles."""
    parts = max(1, parallelism(sample.sparkSession))
    tree, node, x = F.col("tree"), F.col("_node"), F.col("_x")
    rows = (sample.select("tree", F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
            .repartition(parts, "tree").withColumn("_node", F.lit(0))
            .withColumn("_way", F.array().cast(f"array<{NODE}>")))
    w = Window.partitionBy("tree", "_node")
    for depth in range(max_depth + 1):
        ends = [e(x[i]).over(w).alias(f"_{n}{i}") for i in range(len(cols)) for n, e in (("lo", F.min), ("hi", F.max))]
        at = rows.select("*", F.count(F.lit(1)).over(w).alias("_size"), *ends)
        varying = [F.when(F.col(f"_lo{i}") < F.col(f"_hi{i}"),
                          F.concat(_feature_draw(tree, node, seed, i), F.lit(f":{i}"))) for i in range(len(cols))]
        pick = F.split(F.array_min(F.array(*varying)), ":")[1].cast("int")
        grown = node.isNotNull() & (F.col("_size") > 1) if depth < max_depth else F.lit(False)
        at = at.withColumn("_f", F.when(grown, pick))
        lo, hi = (F.get(F.array(*[F.col(f"_{n}{i}") for i in range(len(cols))]), F.col("_f")) for n in ("lo", "hi"))
        u = hash52(seed, "cut", tree.cast("string"), node.cast("string")) / F.lit(float(1 << HASH_BITS))
        cut = lo + u * (hi - lo)
        at = at.withColumn("_cut", F.when(cut > lo, cut).otherwise(hi))
        this = F.struct(node.alias("node"), F.coalesce("_f", F.lit(-1)).alias("feature"), F.col("_cut").alias("threshold"),
                        F.col("_size").alias("size"), F.lit(depth).alias("depth")).cast(NODE)
        below = F.get(x, F.col("_f")) < F.col("_cut")
        rows = at.select("tree", "_x",
                         F.when(F.col("_f").isNotNull(), 2 * node + F.when(below, 1).otherwise(2)).alias("_node"),
                         F.when(node.isNull(), F.col("_way")).otherwise(F.concat("_way", F.array(this))).alias("_way"))
    leaf = F.col("n.feature") < 0
    path = F.floor((F.col("n.depth") + _c_expr(F.col("n.size"))) * PATH_UNIT + 0.5) / PATH_UNIT
    return (rows.select("tree", F.explode("_way").alias("n")).groupBy("tree", "n.node").agg(F.first("n").alias("n"))
            .select("tree", "n.node", "n.feature", "n.threshold",
                    F.when(leaf, -1).otherwise(2 * F.col("n.node") + 1).alias("left"),
                    F.when(leaf, -1).otherwise(2 * F.col("n.node") + 2).alias("right"),
                    "n.size", "n.depth", F.when(leaf, path).alias("path")))


@dataclass
class ForestModel:
    """Node table + scalar parameters. ``nodes`` is small by construction."""
    nodes: DataFrame
    cols: list[str]
    psi: int
    trees: int
    seed: int
    offset: float = 0.0
    contamination: float = 0.08
    scaler: dict = field(default_factory=dict)

    def arrays(self):
        """Dense (trees x max_nodes) arrays for the scorer (bounded size)."""
        pdf = self.nodes.toPandas()
        m = int(pdf["node"].max()) + 1
        t = self.trees
        feat = np.full((t, m), -1, dtype=np.int64)
        thr = np.zeros((t, m))
        left = np.zeros((t, m), dtype=np.int64)
        right = np.zeros((t, m), dtype=np.int64)
        path = np.zeros((t, m))
        ti, ni = pdf["tree"].to_numpy(), pdf["node"].to_numpy()
        feat[ti, ni] = pdf["feature"].to_numpy()
        thr[ti, ni] = pdf["threshold"].fillna(0.0).to_numpy()
        left[ti, ni] = pdf["left"].to_numpy()
        right[ti, ni] = pdf["right"].to_numpy()
        path[ti, ni] = pdf["path"].fillna(0.0).to_numpy()
        return feat, thr, left, right, path


def fit_forest(df: DataFrame, cols: list[str] = FOREST_FEATURES, trees: int = 200,
               psi: int = 256, contamination: float = 0.08, seed: int = 42,
               key: str = EVENT_ID, scaler: dict | None = None) -> ForestModel:
    """J3 + J4 on already-standardised ``cols``. The offset is the exact
    ``contamination`` quantile of the raw training scores."""
    model = grow_forest(df, cols, trees, psi, contamination, seed, key, scaler)
    return with_offset(model, raw_scores(df, model))


def grow_forest(df: DataFrame, cols: list[str], trees: int, psi: int, contamination: float, seed: int,
                key: str = EVENT_ID, scaler: dict | None = None) -> ForestModel:
    """J3 alone: the trees, without an offset."""
    sample, psi_eff = tree_samples(df, cols, trees, psi, seed, key)
    max_depth = int(math.ceil(math.log2(max(psi_eff, 2))))
    # model table; cut lineage from the sample
    nodes = materialize(grow_by_levels(sample, cols, seed, max_depth))
    return ForestModel(nodes, list(cols), psi_eff, trees, seed, 0.0, contamination, scaler or {})


def with_offset(model: ForestModel, scored: DataFrame) -> ForestModel:
    """The offset from the ``_raw`` of the training rows. ``exact_quantile``
    writes their distinct values, so they are scored once."""
    off = exact_quantile(scored.select("_raw"), "_raw", model.contamination).first()[0]
    model.offset = float(off) if off is not None else 0.0
    return model


# ---------------------------------------------------------------- J5 scoring
BLOCK = 256  # rows that go down the trees together: their (tree, row) pairs stay in a core's cache


def _complete_trees(feat, thr, left, right, path):
    """The trees with every leaf's subtree filled up to the depth of the
    deepest: children of k are 2 k + 1 and 2 k + 2, and every place below a
    leaf has its path. Returns (feature, threshold) of the inner places and the
    path of the lowest, tree by tree, and the depth."""
    tree = np.arange(len(feat))[:, None]
    at = np.zeros((len(feat), 1), dtype=np.int64)
    feats, thrs = [np.zeros((len(feat), 0), dtype=np.int64)], [np.zeros((len(feat), 0))]
    while (inner := feat[tree, at] >= 0).any():
        feats.append(np.where(inner, feat[tree, at], 0))
        thrs.append(thr[tree, at])
        below = [np.where(inner, side[tree, at], at) for side in (left, right)]
        at = np.stack(below, axis=2).reshape(len(feat), -1)
    return np.hstack(feats), np.hstack(thrs), path[tree, at], len(feats) - 1


def _score_udf(model: ForestModel):
    feat, thr, path, depth = _complete_trees(*model.arrays())
    n_trees, lowest = path.shape
    base = (np.arange(n_trees) * (lowest - 1))[:, None]
    base_path = (np.arange(n_trees) * lowest)[:, None] - (lowest - 1)
    feat_f, thr_f, path_f = feat.ravel(), thr.ravel(), path.ravel()
    denom = float(c_factor(model.psi)) or 1.0

    @F.pandas_udf(DoubleType())
    def raw(*cols: pd.Series) -> pd.Series:
        X = np.stack([c.to_numpy(dtype=float) for c in cols])
        mean_path = np.empty(X.shape[1])
        for start in range(0, X.shape[1], BLOCK):
            block = X[:, start:start + BLOCK]
            n = block.shape[1]
            values, row = block.ravel(), np.arange(n)
            at = np.zeros((n_trees, n), dtype=np.int64)
            for _ in range(depth):
                node = at + base
                x = values.take(feat_f.take(node) * n + row)
                at = 2 * at + 2 - (x < thr_f.take(node))
            mean_path[start:start + n] = path_f.take(at + base_path).mean(axis=0)
        return pd.Series(-np.power(2.0, -mean_path / denom))
    return raw


def raw_scores(df: DataFrame, model: ForestModel) -> DataFrame:
    """Adds ``_raw`` = -2 ** (-E[path] / c(psi)) (the raw score, in (-1, 0))."""
    return df.withColumn("_raw", _score_udf(model)(*[F.col(c) for c in model.cols]))


def _raw_of_unscaled(df: DataFrame, model: ForestModel) -> DataFrame:
    """``df`` with ``_raw``; the model's scaler is applied first as column
    expressions (into temporary columns, so the output keeps raw features)."""
    if not model.scaler:
        return raw_scores(df, model)
    cols = [c + "__z" for c in model.cols]
    x = standardise(df, model.scaler, model.cols, suffix="__z")
    return x.withColumn("_raw", _score_udf(model)(*[F.col(c) for c in cols])).drop(*cols)


def with_decision(scored: DataFrame, model: ForestModel) -> DataFrame:
    """J5 on rows that have ``_raw``: ``anomaly_score`` = raw - offset and
    ``anomaly_prediction`` (-1/1)."""
    out = scored.withColumn("anomaly_score", F.col("_raw") - F.lit(model.offset)).drop("_raw")
    return out.withColumn("anomaly_prediction", prediction_from_score())


def score_forest(df: DataFrame, model: ForestModel, standardised: bool = False) -> DataFrame:
    """``anomaly_score`` and ``anomaly_prediction``. Unless
    ``standardised``, the model's scaler is applied first."""
    return with_decision(raw_scores(df, model) if standardised else _raw_of_unscaled(df, model), model)


def _split_and_grow(silver: DataFrame, label_col: str, frac: float, seed: int, trees: int, psi: int,
                    contamination: float, cols: list[str], scaled: bool):
    from leakscope.functions.severity import binary_label_expr
    lab = silver.withColumn("label", binary_label_expr(label_col, positive="leak"))
    split = stratified_split(lab, "label", frac, seed)  # a predicate: nothing is copied
    train = split.where(F.col("split") == "train")
    stats = fit_standard_scaler(train, cols) if scaled else {}
    train = standardise(train, stats, cols) if scaled else train
    return grow_forest(train, cols, trees, psi, contamination, seed, scaler=stats), split, train


def fit_pipeline(silver: DataFrame, label_col: str = "is_anomaly", frac: float = 0.2,
                 seed: int = 42, trees: int = 200, psi: int = 256,
                 contamination: float = 0.08, cols: list[str] = FOREST_FEATURES, scaled: bool = True):
    """Split (stratified on leak/not), fit the scaler on train, fit the forest
    on the standardised train rows. Returns (model, split frame). Cuts lie
    between a feature's smallest and largest value, so scaling changes no tree
    but for rounding; without ``scaled`` the readings themselves are cut."""
    model, split, train = _split_and_grow(silver, label_col, frac, seed, trees, psi, contamination, cols, scaled)
    return with_offset(model, raw_scores(train, model)), split


def fit_and_score(silver: DataFrame, label_col: str = "is_anomaly", frac: float = 0.2, seed: int = 42,
                  trees: int = 200, psi: int = 256, contamination: float = 0.08,
                  cols: list[str] = FOREST_FEATURES, scaled: bool = True):
    """``fit_pipeline``, and all rows scored by the model: every row goes down
    the trees once, and the offset is read from the train rows' scores.
    Returns (scored rows, model)."""
    model, split, _ = _split_and_grow(silver, label_col, frac, seed, trees, psi, contamination, cols, scaled)
    scored = as_table(_raw_of_unscaled(split, model), "raw-scores")
    with_offset(model, scored.where(F.col("split") == "train"))
    return with_decision(scored.drop("label", "split"), model), model


def calibrate(scored: DataFrame, q: float = 0.5) -> DataFrame:
    """The median (``q``) score among predicted anomalies, as a cut proposal."""
    a = scored.where(F.col("anomaly_prediction") == -1)
    return exact_quantile(a, "anomaly_score", q, alias="suggested_cut")
