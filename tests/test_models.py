"""Sequence model, dual Gold, positional split and the model registry."""

import os

from pyspark.sql import functions as F

from leakscope.functions.severity import binary_label_expr
from leakscope.operators import registry
from leakscope.operators.forest import fit_pipeline, score_forest
from leakscope.operators.gold import classify
from leakscope.operators.sequence import dual_gold, fit_sequence_model, positional_split
from leakscope.plans import medallion as M
from leakscope.sources import fixtures as fx

from tests.conftest import SF_SMALL


def test_positional_split_exact(spark):
    b = fx.bronze(spark, SF_SMALL)
    sp = positional_split(b, 0.8).toPandas().sort_values(
        ["pipe_segment_id", "event_timestamp", "event_id"]).reset_index(drop=True)
    k = int(0.8 * len(sp))
    assert (sp.split.iloc[:k] == "train").all() and (sp.split.iloc[k:] == "test").all()


def test_sequence_model_dual_gold_and_registry(spark, tmpdir_run):
    sl = fx.slow_leak(spark, SF_SMALL).withColumn("label", binary_label_expr("is_anomaly"))
    model, test = fit_sequence_model(sl, max_iter=50)
    assert test.count() > 0 and set(r.lstm_anomaly for r in test.collect()) <= {0, 1}
    silver = M.fixture_silver(spark, SF_SMALL)
    fm, _ = fit_pipeline(silver, trees=20, psi=64)
    g = classify(score_forest(silver, fm))
    d = dual_gold(g, model)
    assert d.count() == silver.count()
    # rows without 20 earlier readings in their segment are never sequence-flagged
    first = d.where(F.col("event_id").isin([r.event_id for r in silver.orderBy("event_timestamp").limit(1).collect()]))
    assert first.first().lstm_anomaly == 0
    root = os.path.join(tmpdir_run, "models")
    v1 = registry.save_forest(spark, root, "leak_detector", fm)
    v2 = registry.save_forest(spark, root, "leak_detector", fm, alias="production")
    assert (v1, v2) == (1, 2)
    registry.set_alias(spark, root, "leak_detector", "production", 1)
    assert registry.resolve(spark, root, "leak_detector") == 1
    log = os.path.join(root, "leak_detector", "aliases")
    before = spark.read.parquet(log).count()
    hidden = log + ".off"
    os.rename(log, hidden)
    os.makedirs(log)
    open(os.path.join(log, "part-0.parquet"), "w").write("broken")
    try:  # an unreadable log is an error, and nothing is rewritten
        registry.set_alias(spark, root, "leak_detector", "other", 1)
        raise AssertionError("a broken alias log was overwritten")
    except Exception as e:  # noqa: BLE001
        assert "alias log was overwritten" not in str(e)
    os.rename(log, log + ".broken")
    os.rename(hidden, log)
    assert spark.read.parquet(log).count() == before == 2
    back = registry.load(spark, root, "leak_detector", 2)
    a = score_forest(silver, fm).select("event_id", "anomaly_score").orderBy("event_id").toPandas()
    b = score_forest(silver, back).select("event_id", "anomaly_score").orderBy("event_id").toPandas()
    assert (a.anomaly_score.values == b.anomaly_score.values).all()
    registry.save_sequence(spark, root, "sequence_detector", model, alias="production")
    s2 = registry.load(spark, root, "sequence_detector")
    assert s2.n == 20 and s2.scaler == model.scaler
