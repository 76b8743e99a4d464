"""Isolation forest invariants (rows-only check in the driver gate)."""

import numpy as np
from pyspark.sql import functions as F

from leakscope.operators.forest import (c_factor, fit_forest, fit_standard_scaler, score_forest,
                                        standardise, stratified_split, tree_samples)
from leakscope.plans import medallion as M
from leakscope.plans.model_queries import frozen_model
from leakscope.operators.forest import raw_scores
from leakscope.schemas import FOREST_FEATURES

from tests.conftest import SF_SMALL


def test_c_factor():
    assert c_factor(1) == 0 and c_factor(2) == 1
    assert abs(float(c_factor(256)) - 10.244770920116851) < 1e-9


def test_forest_invariants(spark):
    s = M.fixture_silver(spark, SF_SMALL)
    stats = fit_standard_scaler(s, FOREST_FEATURES)
    z = standardise(s, stats, FOREST_FEATURES)
    sample, psi = tree_samples(z, FOREST_FEATURES, 20, 64, 42)
    per_tree = {r.tree: r["count"] for r in sample.groupBy("tree").count().collect()}
    assert len(per_tree) == 20 and set(per_tree.values()) == {psi} and psi == 64
    m = fit_forest(z, FOREST_FEATURES, trees=20, psi=64, contamination=0.08, scaler=stats)
    sc = score_forest(s, m).select("event_id", "anomaly_score", "anomaly_prediction")
    pdf = sc.toPandas()
    raw = pdf.anomaly_score + m.offset
    assert ((raw > -1) & (raw < 0)).all()
    share = (pdf.anomaly_prediction == -1).mean()
    assert 0.06 <= share <= 0.10  # contamination on the training rows
    # same seed, different partitioning -> identical scores
    m2 = fit_forest(z.repartition(7), FOREST_FEATURES, trees=20, psi=64, contamination=0.08,
                    scaler=stats)
    pdf2 = score_forest(s.repartition(3), m2).select("event_id", "anomaly_score").toPandas()
    a = pdf.set_index("event_id").anomaly_score.sort_index()
    b = pdf2.set_index("event_id").anomaly_score.sort_index()
    np.testing.assert_allclose(a.values, b.values, rtol=0, atol=1e-15)


def test_stratified_split_exact_sizes(spark):
    s = M.fixture_silver(spark, SF_SMALL).withColumn(
        "label", F.when(F.col("is_anomaly") == "leak", 1).otherwise(0))
    sp = stratified_split(s, "label", 0.2, 42)
    got = {(r.label, r.split): r["count"] for r in sp.groupBy("label", "split").count().collect()}
    n = {r.label: r["count"] for r in s.groupBy("label").count().collect()}
    for lab, cnt in n.items():
        assert got[(lab, "test")] == int(np.ceil(0.2 * cnt))


def test_frozen_forest_scores_known_row(spark):
    df = spark.createDataFrame([("a", 800.0, 2.0)], "event_id string, pressure_psi double, acoustic_g_rms double")
    r = raw_scores(df, frozen_model(spark)).first()["_raw"]
    # tree0 leaf(depth1,size10), tree1 leaf(depth1,size20), tree2 leaf(depth2,size60)
    e = (1 + c_factor(10) + 1 + c_factor(20) + 2 + c_factor(60)) / 3
    assert abs(r - (-(2 ** (-e / c_factor(256))))) < 1e-12


def test_samples_are_partition_independent_and_follow_one_definition(spark):
    from hashlib import md5
    s = M.fixture_silver(spark, SF_SMALL)
    a, psi = tree_samples(s, FOREST_FEATURES, 5, 8, 42)
    b, _ = tree_samples(s.repartition(5), FOREST_FEATURES, 5, 8, 42)
    ka = sorted((r.tree, r.event_id) for r in a.select("tree", "event_id").collect())
    kb = sorted((r.tree, r.event_id) for r in b.select("tree", "event_id").collect())
    assert psi == 8 and len(ka) == 40 and ka == kb
    ids = [r.event_id for r in s.select("event_id").collect()]

    def h(*x):
        return int(md5(":".join(map(str, x)).encode()).hexdigest()[:13], 16)
    p = 3.0 * 8 / len(ids)
    want = []
    for t in range(5):
        cand = []
        for e in ids:
            first = int(np.floor(np.log(1 - h(42, "first", e) / 2 ** 52) / np.log1p(-p)))
            if t == first or t > first and h(42, "next", t, e) < p * 2 ** 52:
                cand.append((h(42, t, e), e))
        want += [(t, e) for _, e in sorted(cand)[:8]]
    assert ka == sorted(want)


def test_split_has_no_class_limit(spark):
    df = spark.range(1500).selectExpr("cast(id as string) event_id", "id % 300 as label")
    got = stratified_split(df, "label", 0.2, 1).where("split = 'test'").groupBy("label").count().collect()
    assert len(got) == 300 and {r["count"] for r in got} == {1}


def test_levels_grow_isolation_trees(spark):
    """Every node against its own rows: size, cut strictly inside, children."""
    s = M.fixture_silver(spark, SF_SMALL)
    sample, psi = tree_samples(s, FOREST_FEATURES, 6, 32, 5)
    rows = sample.toPandas()
    nodes = {(r.tree, r.node): r for r in fit_forest(s, FOREST_FEATURES, trees=6, psi=32, seed=5).nodes.collect()}
    met = set()
    for tree, own in rows.groupby("tree"):
        todo = [(0, own[FOREST_FEATURES].to_numpy(), 0)]
        while todo:
            k, x, depth = todo.pop()
            n = nodes[tree, k]
            met.add((tree, k))
            assert (n["size"], n.depth) == (len(x), depth)
            if n.feature < 0:
                assert depth == 5 or len(x) == 1 or (x.min(0) == x.max(0)).all()
                assert abs(n.path - depth - c_factor(len(x))) < 1e-9
                continue
            v = x[:, n.feature]
            assert v.min() < n.threshold <= v.max()
            todo += [(n.left, x[v < n.threshold], depth + 1), (n.right, x[v >= n.threshold], depth + 1)]
    assert met == set(nodes)


def test_scaling_changes_no_tree(spark):
    s = M.fixture_silver(spark, SF_SMALL)
    stats = fit_standard_scaler(s, FOREST_FEATURES)
    a = fit_forest(s, FOREST_FEATURES, trees=10, psi=64).nodes
    b = fit_forest(standardise(s, stats, FOREST_FEATURES), FOREST_FEATURES, trees=10, psi=64, scaler=stats).nodes
    shape = lambda n: sorted((r.tree, r.node, r.feature, r["size"]) for r in n.collect())
    assert shape(a) == shape(b)


def test_boxes_give_the_scores_of_the_walk(spark):
    from leakscope.operators.boxes import leaf_boxes, score_boxes
    s = M.fixture_silver(spark, SF_SMALL).limit(300)
    s = s.unionByName(s.limit(3)).cache()     # equal rows too
    m = fit_forest(s, FOREST_FEATURES, trees=10, psi=64)
    boxes = leaf_boxes(m)
    want = sorted((r.event_id, round(r["_raw"], 9)) for r in raw_scores(s, m).collect())
    for limit in (10 ** 9, 0):   # broadcast, and shuffled
        out = score_boxes(s, boxes, FOREST_FEATURES, m.psi, max_broadcast=limit)
        assert sorted((r.event_id, round(r["_raw"], 9)) for r in out.collect()) == want
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
