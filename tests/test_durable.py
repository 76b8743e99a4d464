"""Replays over runs, atomic publication, version claims, named tables that
grow columns, and a progress log that outlives its query."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from leakscope.operators import registry
from leakscope.operators.forest import ForestModel
from leakscope.plans.model_queries import frozen_model
from leakscope.sources import versions as V
from leakscope.sources.tables import append_evolving, drop_table, table_audit
from leakscope.streaming import replay as R


def _messages(d, name, ids, day=3, at=1_700_000_000):
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, name)
    with open(path, "w") as fh:
        for i in ids:
            fh.write(json.dumps({"event_id": f"e{i}", "pipe_segment_id": f"P{i % 2}", "event_timestamp": None if day is None else
                                 f"2024-01-{day:02d}T00:00:{i % 60:02d}Z", "pressure_psi": 900.0 + i, "flow_rate_lpm": 1.0,
                                 "acoustic_g_rms": 0.1, "temperature_c": 20.0, "is_anomaly": "normal"}) + "\n")
    os.utime(path, (at, at))


def test_replay_adds_nothing_in_any_run(spark, tmpdir_run):
    src, out, keys = (os.path.join(tmpdir_run, x) for x in ("m", "out", "keys"))
    ids = lambda: sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect())
    _messages(src, "a.json", [1, 2, 2, 3])
    _messages(src, "b.json", [3, 4], at=1_700_000_010)
    _messages(src, "no-time.json", [70, 70], None, at=1_700_000_020)
    R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck1"), max_per_trigger=1)
    assert ids() == ["e1", "e2", "e3", "e4", "e70"]
    # weeks later all is sent again, with one old reading that never came before
    _messages(src, "again.json", [1, 2, 3, 4, 5], at=1_702_000_000)
    _messages(src, "no-time-again.json", [70], None, at=1_702_000_000)
    R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck1"))
    assert ids() == ["e1", "e2", "e3", "e4", "e5", "e70"]
    # the checkpoint is lost: everything is read again from the start
    R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck2"), max_per_trigger=2)
    assert ids() == ["e1", "e2", "e3", "e4", "e5", "e70"]
    # a trigger that failed before its commit is repeated
    for name in ("3", ".3.crc"):
        os.rename(os.path.join(tmpdir_run, "ck1", "commits", name), os.path.join(tmpdir_run, f"gone{name}"))
    R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck1"))
    assert ids() == ["e1", "e2", "e3", "e4", "e5", "e70"]
    # the same id on another day is another message
    _messages(src, "other.json", [1], day=9, at=1_703_000_000)
    R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck1"))
    assert ids().count("e1") == 2


def test_progress_outlives_the_query(spark, tmpdir_run):
    src, out, keys = (os.path.join(tmpdir_run, x) for x in ("m", "out", "keys"))
    _messages(src, "a.json", range(5))
    _messages(src, "b.json", range(5, 9), at=1_700_000_010)
    with R.ProgressLog(spark, os.path.join(tmpdir_run, "log")) as log:
        R.run_bronze_once(spark, "text", src, out, keys, os.path.join(tmpdir_run, "ck"), max_per_trigger=1)

        def broken(batch, k):
            raise RuntimeError("sink is down")
        q = (spark.readStream.text(src).writeStream.foreachBatch(broken)
             .option("checkpointLocation", os.path.join(tmpdir_run, "ck3")).trigger(availableNow=True).start())
        with pytest.raises(Exception, match="sink is down"):
            q.awaitTermination()
    got = {r["state"]: r for r in R.rates(log.read()).collect()}
    assert not log.failed
    assert got["ended"]["rows"] == 9 and got["ended"]["triggers"] >= 2 and got["ended"]["slowest_ms"] > 0
    assert "sink is down" in got["failed"]["error"]


def test_killed_replace_leaves_the_old_table(spark, tmpdir_run):
    root = os.path.join(tmpdir_run, "t")
    with pytest.raises(FileNotFoundError):
        V.load_version(spark, root)
    assert V.publish(spark.range(10).withColumn("p", F.col("id") % 2), root, ["p"]) == 1
    pinned = V.load_version(spark, root)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
    with pytest.raises(Exception, match="killed"):
        V.publish(broken, root)
    assert V.current(spark, root) == 1 and V.load_version(spark, root).count() == 10
    assert V.publish(spark.range(3), root) == 3       # the dead writer's number is not used again
    assert V.load_version(spark, root).count() == 3 and pinned.count() == 10
    assert V.load_version(spark, root, 1).count() == 10
    with pytest.raises(FileNotFoundError):
        V.load_version(spark, root, 2)
    with pytest.raises(ValueError):
        V.commit(spark, root, 3)


def test_two_writers_get_two_versions(spark, tmpdir_run):
    base = frozen_model(spark)
    got, failed = [], []

    def save(offset):
        try:
            m = ForestModel(base.nodes, base.cols, base.psi, base.trees, base.seed, offset)
            got.append((registry.save_forest(spark, tmpdir_run, "m", m), offset))
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    each = [threading.Thread(target=save, args=(float(i),)) for i in range(4)]
    [t.start() for t in each]
    [t.join() for t in each]
    assert not failed and sorted(v for v, _ in got) == [1, 2, 3, 4]
    assert all(registry.load(spark, tmpdir_run, "m", v).offset == offset for v, offset in got)
    # a version whose writer died is none
    os.makedirs(os.path.join(tmpdir_run, "m", "v9", "nodes"))
    assert registry.resolve(spark, tmpdir_run, "m") == 4
    assert registry.save_forest(spark, tmpdir_run, "m", base) == 10


def test_named_table_grows(spark):
    name = "grown_readings"
    drop_table(spark, name)
    append_evolving(spark.createDataFrame([(1, 1.5, "a")], "id long, x double, seg string"), name, ["seg"])
    append_evolving(spark.createDataFrame([(2, "a", 2.5, "new")], "ID int, seg string, x float, note string"), name)
    append_evolving(spark.createDataFrame([("b", 3)], "seg string, id long"), name)
    got = sorted(spark.table(name).select("id", "x", "note", "seg").collect())
    assert [tuple(r) for r in got] == [(1, 1.5, None, "a"), (2, 2.5, "new", "a"), (3, None, None, "b")]
    for bad in ("id string, seg string", "id decimal(20,0), seg string"):
        with pytest.raises(ValueError, match="without loss"):
            append_evolving(spark.createDataFrame([], bad), name)
    assert spark.table(name).count() == 3
    drop_table(spark, name)


def test_audit_tells_a_broken_table_from_a_missing_one(spark, tmpdir_run):
    assert table_audit(spark, [(os.path.join(tmpdir_run, "no"), "x"), ("no_such_table", "x")]).where(
        "status = 'missing table'").count() == 2
    bad = os.path.join(tmpdir_run, "bad")
    os.makedirs(bad)
    open(os.path.join(bad, "part-0.parquet"), "w").write("broken")
    with pytest.raises(Exception):
        table_audit(spark, [(bad, "x")]).collect()
