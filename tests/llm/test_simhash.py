import random

import numpy as np
import pytest

from leakscope.llm import simhash
from tests.llm import brute


def _docs(seed, n=150):
    r = random.Random(seed)
    vocab = [f"W{i}" for i in range(60)]
    base = [[r.choice(vocab) for _ in range(r.choice([0, 1, 2, 3, 40, 200]))] for _ in range(8)]
    out = [(1000, None), (1001, ""), (1002, "x"), (1003, "X \t"), (1004, "x y"), (1005, "É é")]
    for i in range(n):
        x = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            if x:
                x[r.randrange(len(x))] = r.choice(vocab)
        out.append((i, r.choice([" ", "\n", "  "]).join(x)))
    return out + [out[10], out[11]]


@pytest.mark.parametrize("seed,crowd,block,parts", [(1, 48, 1024, 3), (2, 2, 8, 3), (3, 48, 1024, 4), (4, 1, 4, 2)])
def test_components_match_brute_force(docs_of, monkeypatch, seed, crowd, block, parts):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "BLOCK", block)
    docs = _docs(seed)
    got = simhash.near_duplicates(docs_of(docs), parts=parts).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute.simhash_groups(docs))


def test_fingerprint_in_portions(monkeypatch):
    t = " ".join(f"w{i % 97}" for i in range(5000))
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.text_fingerprint(t) & (1 << 64) - 1 == brute.simhash(t)


def test_thresholds_satisfy_the_pigeonhole():
    rng = np.random.default_rng(1)
    dealt = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
    hist = rng.integers(0, 50, (3, 1 << 16)).astype(float)
    values = [rng.integers(0, 1 << len(d), 500) for d in dealt]
    t = simhash.thresholds(values, dealt, hist, 3)
    assert ((t + 1).sum(1) == 4).all() and (t >= -1).all()


def test_partitions_cover_all_bits_and_group_correlated_ones(spark):
    r = random.Random(1)
    fps = []
    for _ in range(400):
        x = r.getrandbits(64)
        for b in range(1, 8):  # bits 0, 10, 20, ... follow bit 0
            x = x & ~(1 << 8 * b) | (x & 1) << 8 * b
        fps.append((x - (1 << 64) if x >> 63 else x,))
    dealt = simhash.partitions(spark.createDataFrame(fps, "fp long"), 3)
    assert sorted(b for d in dealt for b in d) == list(range(64))
    assert any({0, 8, 16, 24, 32, 40, 48, 56} <= set(d) for d in dealt)


def test_null_ids_and_empty(docs_of):
    got = simhash.near_duplicates(docs_of([(None, "a b c"), (None, "a b c"), (4, "q r s t")])).collect()
    assert {(r["doc_id"], r["component_id"], r["class_size"]) for r in got} == {(None, None, 2), (4, 4, 1)}
    assert simhash.near_duplicates(docs_of([(1, "a")]).where("doc_id = 2")).collect() == []


def test_one_row_of_each_component_stays(spark):
    t, u, v = "a b c d e f", "completely other words stand here now", "and a third text of its own words"
    rows = [(3, t), (5, u), (5, t), (7, v), (7, v), (None, u), (None, "lonely text without any id at all"), (None, "lonely text without any id at all")]
    docs = spark.createDataFrame([(d, x, "n") for d, x in rows], "doc_id long, text string, fp string").repartition(3)
    got = sorted((str(r["doc_id"]), r["text"]) for r in simhash.one_of_each(docs).collect())
    assert got == sorted([("3", t), ("5", u), ("7", v), ("None", "lonely text without any id at all")])
    assert simhash.one_of_each(docs.where("doc_id = 0")).collect() == []
