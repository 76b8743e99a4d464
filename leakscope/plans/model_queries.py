"""Registered queries that involve a model.

``C1_frozen_forest_score`` scores Silver rows with a fixed three-tree forest
through the same vectorised scorer as the real model; its oracle scores the
rows by a range join against the forest's leaf boxes. The fitted forests' SQL
grows the same trees level by level and walks every row down all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from leakscope.functions.rounding import round_half_up as rhu
from leakscope.functions.rounding import round_sql as R
from leakscope.operators.forest import EULER_GAMMA, NODE_SCHEMA, ForestModel, c_factor, raw_scores
from leakscope.operators.gold import gold_table
from leakscope.operators.lineage import as_table
from leakscope.plans import medallion as M
from leakscope.plans.catalog import _HASH, SF, query, report_sql
from leakscope.schemas import EVENT_ID, FOREST_FEATURES, GOLD_COLUMNS
from leakscope.sources import fixtures as fx

# Fixed test model: three depth-2 trees over (pressure_psi, acoustic_g_rms),
# rows (tree, node, feature, threshold, left, right, size, depth); feature -1 = leaf.
FROZEN_COLS = ["pressure_psi", "acoustic_g_rms"]
FROZEN_PSI = 256
FROZEN_NODES = [
    (0, 0, 0, 850.0, 1, 2, 215, 0), (0, 1, -1, None, -1, -1, 10, 1),
    (0, 2, 1, 1.0, 3, 4, 205, 1), (0, 3, -1, None, -1, -1, 200, 2), (0, 4, -1, None, -1, -1, 5, 2),
    (1, 0, 1, 0.8, 1, 2, 173, 0), (1, 1, 0, 900.0, 3, 4, 153, 1), (1, 2, -1, None, -1, -1, 20, 1),
    (1, 3, -1, None, -1, -1, 3, 2), (1, 4, -1, None, -1, -1, 150, 2),
    (2, 0, 0, 1000.0, 1, 2, 256, 0), (2, 1, 0, 700.0, 3, 4, 64, 1), (2, 2, -1, None, -1, -1, 192, 1),
    (2, 3, -1, None, -1, -1, 4, 2), (2, 4, -1, None, -1, -1, 60, 2),
]


def _with_path(rows):
    out = []
    for t, n, f, thr, left, right, size, depth in rows:
        path = float(depth + c_factor(size)) if f < 0 else None
        out.append((t, n, f, thr, left, right, size, depth, path))
    return out


def frozen_model(spark: SparkSession) -> ForestModel:
    nodes = spark.createDataFrame(_with_path(FROZEN_NODES), NODE_SCHEMA)
    return ForestModel(nodes, FROZEN_COLS, FROZEN_PSI, 3, 0)


def _leaf_boxes() -> list[tuple]:
    """(tree, bounds per feature, path) of every leaf, by walking the trees."""
    rows = {(r[0], r[1]): r for r in _with_path(FROZEN_NODES)}
    boxes = []

    def walk(t, n, lo, hi):
        r = rows[(t, n)]
        f = r[2]
        if f < 0:
            boxes.append((t, list(lo), list(hi), r[8]))
            return
        h2 = list(hi)
        h2[f] = r[3] if h2[f] is None else min(h2[f], r[3])
        walk(t, r[4], lo, h2)
        l2 = list(lo)
        l2[f] = r[3] if l2[f] is None else max(l2[f], r[3])
        walk(t, r[5], l2, hi)
    for t in sorted({k[0] for k in rows}):
        walk(t, 0, [None] * len(FROZEN_COLS), [None] * len(FROZEN_COLS))
    return boxes


def _lit(v):
    return "CAST(NULL AS DOUBLE)" if v is None else repr(float(v))


def _c1_oracle() -> str:
    values = ", ".join(
        "(" + ", ".join([str(t)] + [_lit(x) for pair in zip(lo, hi) for x in pair] + [repr(p)]) + ")"
        for t, lo, hi, p in _leaf_boxes())
    names = ["tree"] + [f"{c}_{e}" for c in FROZEN_COLS for e in ("lo", "hi")] + ["path"]
    conds = " AND ".join(f"(b.{c}_lo IS NULL OR s.{c} >= b.{c}_lo) AND (b.{c}_hi IS NULL OR s.{c} < b.{c}_hi)"
                         for c in FROZEN_COLS)
    denom = repr(float(c_factor(FROZEN_PSI)))
    body = (f"SELECT s.event_id, {R(f'-POWER(2.0, -AVG(b.path) / {denom})', 6)} AS raw_score "
            f"FROM fx_silver s JOIN boxes b ON {conds} GROUP BY s.event_id")
    return fx.with_fixtures(body, "fx_silver",
                            extra=[("boxes", f"SELECT * FROM (VALUES {values}) AS v({', '.join(names)})")])


@query("C1_frozen_forest_score", _c1_oracle())
def c1(spark, sf) -> DataFrame:
    s = M.fixture_silver(spark, sf)
    return raw_scores(s, frozen_model(spark)).select(EVENT_ID, rhu("_raw", 6).alias("raw_score"))


@query("C1_score_boxes", _c1_oracle())
def c1_boxes(spark, sf) -> DataFrame:
    """The same scores by a range join against the forest's leaf boxes."""
    from leakscope.operators.boxes import leaf_boxes, score_boxes
    rows = M.fixture_silver(spark, sf).select(EVENT_ID, *FROZEN_COLS)
    out = score_boxes(rows, leaf_boxes(frozen_model(spark)), FROZEN_COLS, FROZEN_PSI)
    return out.select(EVENT_ID, rhu("_raw", 6).alias("raw_score"))


def _forest_sql(rows: str, trees: int = 200, psi: int = 256, seed: int = 42, cols=FOREST_FEATURES) -> list[tuple[str, str]]:
    """CTEs that grow the forest on the table ``rows``: ``smp``, a pair of
    tables for each level, and ``nodes``."""
    n, k = f"(SELECT COUNT(*) FROM {rows})", len(cols)
    p = f"LEAST(1.0, 3.0 * LEAST({psi}, {n}) / {n})"
    h = lambda *parts: _HASH.format(", ".join(f"CAST({x} AS VARCHAR)" for x in parts))
    two52 = "4503599627370496.0"
    out = [
        ("cand", f"SELECT f.*, t.tree FROM (SELECT *, CASE WHEN {p} < 1 THEN CAST(FLOOR(LN(1 - {h(seed, "'first'", 'event_id')} / {two52}) "
                 f"/ LN(1 - {p})) AS BIGINT) ELSE 0 END AS first FROM {rows}) f "
                 f"JOIN (SELECT CAST(unnest(range(0, {trees})) AS INTEGER) AS tree) t ON t.tree >= f.first "
                 f"WHERE t.tree = f.first OR {p} >= 1 OR {h(seed, "'next'", 't.tree', 'f.event_id')} < {p} * {two52}"),
        ("smp", f"SELECT tree, [{', '.join(cols)}] AS x, CAST(0 AS BIGINT) AS node FROM (SELECT *, ROW_NUMBER() OVER "
                f"(PARTITION BY tree ORDER BY {h(seed, 'tree', 'event_id')}, event_id) AS i FROM cand) WHERE i <= {psi}")]
    depth = max(0, math.ceil(math.log2(max(2, psi))))
    level = "smp"
    for d in range(depth + 1):
        ends = ", ".join(f"MIN(x[{i + 1}]) OVER w AS lo{i}, MAX(x[{i + 1}]) OVER w AS hi{i}" for i in range(k))
        m = f"md5(concat_ws(':', '{seed}', 'feature0', CAST(tree AS VARCHAR), CAST(node AS VARCHAR)))"
        draws = ", ".join(f"CASE WHEN lo{i} < hi{i} THEN substr({m}, {4 * i + 1}, 4) || ':{i}' END" for i in range(k))
        pick = f"CASE WHEN size > 1 THEN CAST(split_part(list_min([{draws}]), ':', 2) AS INTEGER) END" if d < depth else "CAST(NULL AS INTEGER)"
        lo, hi = ("[" + ", ".join(f"{e}{i}" for i in range(k)) + "][f + 1]" for e in ("lo", "hi"))
        out += [
            (f"lv{d}", f"SELECT *, {pick} AS f FROM (SELECT *, COUNT(*) OVER w AS size, {ends} FROM {level} WINDOW w AS (PARTITION BY tree, node))"),
            (f"ct{d}", f"SELECT tree, x, node, size, f, CASE WHEN c > l THEN c WHEN f IS NOT NULL THEN h END AS cut FROM (SELECT *, {lo} AS l, {hi} AS h, "
                       f"{lo} + {h(seed, "'cut'", 'tree', 'node')} / {two52} * ({hi} - {lo}) AS c FROM lv{d})"),
            (f"to{d}", f"SELECT tree, x, CASE WHEN x[f + 1] < cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node FROM ct{d} WHERE f IS NOT NULL")]
        level = f"to{d}"
    c = (f"CASE WHEN size > 2 THEN 2.0E0 * (LN(size - 1.0E0) + {EULER_GAMMA!r}) - 2.0E0 * (size - 1.0E0) / size "
         "WHEN size = 2 THEN 1.0E0 ELSE 0.0E0 END")
    each = " UNION ALL ".join(f"SELECT DISTINCT tree, node, f, cut, size, {d} AS depth FROM ct{d}" for d in range(depth + 1))
    out.append(("nodes", f"SELECT *, CASE WHEN f IS NULL THEN FLOOR((depth + {c}) * 4294967296.0E0 + 0.5E0) / 4294967296.0E0 END AS path FROM ({each})"))
    return [(name, sql) for name, sql in out]


def _score_sql(rows: str, name: str, psi: int = 256, cols=FOREST_FEATURES) -> list[tuple[str, str]]:
    """CTE ``name``: (event_id, raw) of the rows, walked down all trees."""
    depth, out = math.ceil(math.log2(psi)), []
    level = f"{name}_w0"
    out.append((level, f"SELECT event_id, [{', '.join(cols)}] AS x, tree, CAST(0 AS BIGINT) AS node FROM {rows}, (SELECT DISTINCT tree FROM nodes)"))
    for d in range(depth):
        out.append((f"{name}_w{d + 1}", "SELECT event_id, x, w.tree, CASE WHEN f IS NULL THEN w.node WHEN x[f + 1] < cut THEN 2 * w.node + 1 "
                    f"ELSE 2 * w.node + 2 END AS node FROM {level} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node"))
        level = f"{name}_w{d + 1}"
    out.append((name, f"SELECT event_id, -POWER(2.0E0, -AVG(path) / {float(c_factor(psi))!r}) AS raw FROM {level} w "
                "JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY event_id"))
    return out


_SPLIT_SQL = [
    ("sp_l", "SELECT *, CASE WHEN is_anomaly = 'leak' THEN 1 ELSE 0 END AS label FROM fx_silver"),
    ("sp_r", f"SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_HASH.format("'42', event_id")}, event_id) AS i, "
             "COUNT(*) OVER (PARTITION BY label) AS n_of FROM sp_l"),
    ("split", "SELECT * EXCLUDE (i, n_of), CASE WHEN i <= CEIL(0.2 * n_of) THEN 'test' ELSE 'train' END AS split FROM sp_r"),
    ("train", "SELECT * FROM split WHERE split = 'train'")]
_SCORED_SQL = [*_SPLIT_SQL, *_forest_sql("train"), *_score_sql("split", "raws"),
               ("cutoff", "SELECT QUANTILE_CONT(raw, 0.08) AS c FROM raws JOIN train USING (event_id)"),
               ("sc", "SELECT s.* EXCLUDE (label, split), s.label AS leak, s.split, raw - (SELECT c FROM cutoff) AS anomaly_score "
                      "FROM split s JOIN raws USING (event_id)")]


@query("J3_forest_nodes", fx.with_fixtures(
    f"SELECT tree, CAST(node AS INTEGER) AS node, COALESCE(f, -1) AS feature, {R('cut', 6)} AS threshold, size, depth, {R('path', 6)} AS path FROM nodes",
    "fx_silver", extra=_forest_sql("fx_silver", trees=50)))
def j3_nodes(spark, sf) -> DataFrame:
    """The node table of 50 trees grown on all Silver rows."""
    from leakscope.operators.forest import fit_forest
    # read for the row count, the samples and the scores
    rows = as_table(M.fixture_silver(spark, sf).select(EVENT_ID, *FOREST_FEATURES), "features")
    model = fit_forest(rows, FOREST_FEATURES, trees=50)
    return model.nodes.select("tree", "node", "feature", rhu("threshold", 6).alias("threshold"), "size", "depth",
                              rhu("path", 6).alias("path"))


@query("J3_J5_forest_gold", fx.with_fixtures(
    "SELECT " + ", ".join(R(c, 6) + f" AS {c}" if c == "anomaly_score" else c for c in GOLD_COLUMNS) + " FROM fg",
    "fx_silver", extra=[*_SCORED_SQL, ("fg", "WITH " + fx.CLASSIFY_SQL)]))
def j35(spark, sf) -> DataFrame:
    """Split, 200 trees fitted on the train rows, all rows scored and classified.
    The readings are not scaled, so that both engines cut the same doubles."""
    g, _ = M.model_gold(M.fixture_silver(spark, sf), scaled=False)
    return gold_table(g, with_clock=False).withColumn("anomaly_score", rhu("anomaly_score", 6))



def _training_rows(spark, sf, silver=None):
    """G2 with ids: Silver and slow-leak rows together, a sequence never mixing
    the two (each keeps its own segments)."""
    from pyspark.sql import functions as F

    from leakscope.functions.severity import binary_label_expr
    from leakscope.schemas import EVENT_TS, SEGMENT, SENSORS
    keep = [EVENT_ID, SEGMENT, EVENT_TS, *SENSORS, "is_anomaly"]
    leak = fx.slow_leak(spark, sf).select(*keep).withColumn(SEGMENT, F.concat(SEGMENT, F.lit("_slow"))) \
        .withColumn(EVENT_ID, F.concat(F.lit("s"), F.col(EVENT_ID)))
    rows = (M.fixture_silver(spark, sf) if silver is None else silver).select(*keep).unionByName(leak)
    return rows.withColumn("label", binary_label_expr("is_anomaly"))


@query("J8_sequence_model")
def j8(spark, sf) -> DataFrame:
    """Held-out (last 20 % by position) predictions of the sequence classifier."""
    from leakscope.operators.sequence import fit_sequence_model
    _, test = fit_sequence_model(_training_rows(spark, sf))
    return test.select(EVENT_ID, "pipe_segment_id", "label", "lstm_anomaly")


@query("J6_dual_gold")
def j6(spark, sf) -> DataFrame:
    """Gold with both detectors: forest on Silver, sequence model trained on
    Silver and slow-leak rows, both flags as columns of one frame."""
    from leakscope.operators.sequence import dual_gold, fit_sequence_model
    silver = as_table(M.fixture_silver(spark, sf), "silver")  # both models' rows
    seq_model, _ = fit_sequence_model(_training_rows(spark, sf, silver))
    g, _ = M.model_gold(silver)
    return dual_gold(g, seq_model)


@query("A15_to_messages", fx.with_fixtures(
    "SELECT pipe_segment_id AS \"key\", event_id, is_anomaly, flow_rate_lpm, "
    "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp FROM fx_bronze", "fx_bronze"))
def a15(spark, sf) -> DataFrame:
    """Bronze rows as (key, JSON value) messages; the fields read from the JSON."""
    from pyspark.sql import functions as F

    from leakscope.sources.messages import to_messages
    field = lambda n: F.get_json_object("value", f"$.{n}")
    return to_messages(M.fixture_bronze(spark, sf)).select(
        "key", field("event_id").alias("event_id"), field("is_anomaly").alias("is_anomaly"),
        field("flow_rate_lpm").cast("double").alias("flow_rate_lpm"), field("event_timestamp").alias("event_timestamp"))


_HELD_OUT = (f"SELECT {SF('y = 0 AND p = 0')} AS tn, {SF('y = 0 AND p = 1')} AS fp, {SF('y = 1 AND p = 0')} AS fn, "
             f"{SF('y = 1 AND p = 1')} AS tp FROM (SELECT leak AS y, CASE WHEN anomaly_score < 0 THEN 1 ELSE 0 END AS p "
             "FROM sc WHERE split = 'test')")


@query("J9_forest_holdout_report", report_sql(_HELD_OUT, "fx_silver", _SCORED_SQL, ("Normal", "Leak")))
def j9(spark, sf) -> DataFrame:
    """Classification report of the forest on its 20 % stratified hold-out
    (label: leak; prediction: anomaly)."""
    from pyspark.sql import functions as F

    from leakscope.operators.forest import fit_pipeline, score_forest
    from leakscope.operators.metrics import classification_report
    silver = as_table(M.fixture_silver(spark, sf), "silver")
    model, split = fit_pipeline(silver, scaled=False)
    test = split.where(F.col("split") == "test").drop("split")
    scored = score_forest(test, model).withColumn(
        "pred", F.when(F.col("anomaly_prediction") == -1, 1).otherwise(0))
    return classification_report(scored, "label", "pred", names=("Normal", "Leak"))
