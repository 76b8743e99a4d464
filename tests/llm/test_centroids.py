import hashlib
import math
import random

import numpy as np
import pytest

from leakscope.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cluster int, hash string"


@pytest.fixture(scope="module")
def vectors_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, None, "x", 3, None) for i, v in rows], SCHEMA).repartition(3)
    return make


def brute(rows, clusters=8, rounds=10):
    v = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
         if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cs = [x for _, x in sorted(v, key=key)[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x: min(((far(x, c), k) for k, c in enumerate(cs)))
    for _ in range(rounds):
        own = [near(x)[1] for _, x in v]
        for k in range(len(cs)):
            g = [x for (_, x), o in zip(v, own) if o == k]
            if g:
                cs[k] = [sum(col) // len(g) for col in zip(*g)]
    last = [(i, *near(x)) for i, x in v]
    per = [sum(d for _, d, k in last if k == c) for c in range(len(cs))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((str(i), k, d, per[k], sum(per), names[k]) for i, d, k in last)


def rows_of(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in df.collect())


def _cases(seed, n):
    r = random.Random(seed)
    middle = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    out = [(i, [r.gauss(m, .2) for m in r.choice(middle)]) for i in range(n)]
    out += [(1000 + i, out[0][1]) for i in range(n // 3)] + [out[1]] * 3 + [(0, out[2][1])]   # copies, repeats, one id twice
    return out + [(5000, None), (5001, []), (5002, [1.0] * 63), (5003, [None] + [0.0] * 63), (5004, [float("nan")] * 64),
                  (5005, [float("inf")] * 64), (None, [0.5] * 64), (5006, [-0.0004] * 64), (5007, [100_000.0, -100_000.0] * 32)]


@pytest.mark.parametrize("seed,n", [(1, 60), (2, 150)])
def test_equals_brute_force(vectors_of, seed, n):
    rows = _cases(seed, n)
    assert rows_of(C.report(vectors_of(rows))) == brute(rows)


def test_few_equal_and_no_rows(vectors_of):
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert rows_of(C.report(vectors_of(few))) == brute(few)
    same = [(i, [1.0] * 64) for i in range(30)]      # all centroids tie: the smallest number wins
    assert rows_of(C.report(vectors_of(same))) == brute(same)
    assert C.report(vectors_of([(1, None)])).collect() == []
    assert C.report(vectors_of([(1, None)]).where("vec_id = 2")).collect() == []


def test_too_large_for_a_long_is_refused(vectors_of):
    with pytest.raises(Exception, match="too large"):
        C.report(vectors_of([(1, [3e38] * 64)])).collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_hold_and_skip(seed):
    r = np.random.default_rng(seed)
    middle = r.integers(-20_000, 20_000, (8, 64))
    v = middle[r.integers(0, 8, 500)] + r.integers(-900, 900, (500, 64))
    cs = middle + r.integers(-900, 900, (8, 64))
    pivots = C.chosen_pivots(v[:64], 6)
    low = C.bounds(C._distances(v, pivots), C._distances(cs, pivots), C._distances(pivots, pivots))
    exact = ((v[:, None] - cs[None]) ** 2).sum(2)
    assert (low <= exact).all()
    cluster, best, made = C.assign(v, low, cs)
    assert (best == exact.min(1)).all() and (cluster == exact.argmin(1)).all()
    assert made < 0.7 * exact.size  # most exact comparisons are skipped
