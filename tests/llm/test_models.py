import itertools
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from leakscope.llm import hmm, imatch, toxicity
from leakscope.llm.common import table
from tests.conftest import SF_MID
from tests.llm import brute


# Hidden Markov model

def _tiny(seed=1, states=3, symbols=4):
    r = np.random.default_rng(seed)
    return (r.dirichlet(np.ones(states)), r.dirichlet(np.ones(states), states), r.dirichlet(np.ones(symbols), states).T)


def _paths(seq, start, move, emit):
    for path in itertools.product(range(len(start)), repeat=len(seq)):
        p = start[path[0]] * emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= move[path[t - 1], path[t]] * emit[seq[t], path[t]]
        yield path, p


def test_forward_and_expected_counts_equal_enumeration():
    start, move, emit = _tiny()
    seqs = [[0, 1, 3, 2, 1], [2, 2], [3]]
    tokens = np.zeros((5, 3), np.int32)
    for i, s in enumerate(seqs):
        tokens[:len(s), i] = s
    n = np.array([len(s) for s in seqs])
    like = hmm.forward(tokens, n, start, move, emit)
    s0, m0, e0 = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for i, s in enumerate(seqs):
        all_ = list(_paths(s, start, move, emit))
        total = sum(p for _, p in all_)
        assert like[i] == pytest.approx(math.log10(total))
        for path, p in all_:
            s0[path[0]] += p / total
            for t, k in enumerate(path):
                e0[s[t], k] += p / total
                if t:
                    m0[path[t - 1], k] += p / total
    got = hmm.expected(tokens, n, np.ones(3, bool), *(x.astype(np.float32) for x in (start, move, emit)))
    for a, b in zip(got, (s0, m0, e0)):
        assert np.allclose(a, b, atol=1e-4)


def test_scores(spark, docs_of):
    r = random.Random(2)
    docs = [(i, " ".join(r.choice(["A", "b", "c", f"rare{i}", "é", "É"]) for _ in range(r.randrange(30)))) for i in range(60)]
    docs += [(100, None), (101, ""), (None, "b b"), docs[3]]
    train = [(d, t) for d, t in docs if d is None or crc32(str(d).encode()) % 7 != 2]
    count = Counter(x for _, t in train for x in [*brute.WORD.findall(brute.ascii_lower(t or "")), "\n"])
    n, v = sum(count.values()), len(count)
    got = hmm.score(docs_of(docs), states=2, emitted=3, listed=5, passes=2).collect()
    assert len(got) == len(docs)
    want = []
    for d, t in docs:
        w = [*brute.WORD.findall(brute.ascii_lower(t or "")), "\n"]
        want.append((str(d), d is not None and crc32(str(d).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n,
                     round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted((str(x[0]), *x[1:5], round(x[5], 6)) for x in got) == sorted(want)
    assert all(x["score"] < 0 for x in got)


def test_one_state_is_a_smoothed_unigram_model(docs_of):
    docs = [(i, "a b a c") for i in range(20)]
    for x in hmm.score(docs_of(docs), states=1, emitted=100, listed=100, passes=3).collect():
        assert x["score"] == pytest.approx(x["base_score"], rel=0.05)


def test_training_raises_held_out_likelihood(spark):
    docs = table(spark, SF_MID, "documents")
    total = {}
    for passes in (1, 5):
        s = hmm.score(docs, passes=passes).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
        total[passes] = s["sum(score)"]
        assert s["sum(score)"] > s["sum(base_score)"]
    assert total[5] > total[1]


def test_no_training_rows(docs_of):
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    got = hmm.score(docs_of([(held, "a b")])).collect()
    assert (got[0]["n_known"], got[0]["train_tokens"], got[0]["n_tokens"]) == (0, 0, 3)
    assert hmm.score(docs_of([(held, "a b")]).where("doc_id = -1")).collect() == []


# Toxicity

def test_nearest_is_exact():
    r = random.Random(1)
    vocab = [f"t{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = [(i, i % 3 == 0, " ".join(r.choice(vocab) for _ in range(r.randrange(12)))) for i in range(500)]
    idf = np.array([1 + r.random() for _ in vocab])
    index = toxicity.Index(vocab, idf, rows)
    vec = {}
    for i, _, t in rows:
        v = np.zeros(len(vocab))
        for w, n in Counter(t.split()).items():
            v[vocab.index(w)] = (1 + math.log(n)) * idf[vocab.index(w)]
        vec[i] = v / (np.linalg.norm(v) or 1)
    for q in range(0, 500, 7):
        found, cos = index.all.nearest([index.vectors([rows[q][2]])[0][0]], 9)[0]
        want = sorted((float(vec[q] @ vec[int(d)]) for d in index.ids), reverse=True)[:9]
        assert np.allclose(cos, [x for x in want if x > 0], atol=1e-5)
        assert np.allclose(cos, [vec[q] @ vec[int(index.ids[f])] for f in found], atol=1e-5)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.predicted == got.toxic).mean()) > 0.9
    assert got[got.toxic == 1].score.mean() > 3 * got[got.toxic == 0].score.mean()


def test_every_shared_word_finds_its_neighbours(spark, docs_of):
    r = random.Random(3)
    vocab = [f"{a}{b}stone" for a in "bcdfghklmn" for b in "aeiou"]
    docs = [(i, " ".join(["idiot"] * (i % 4 == 0) + r.sample(vocab, r.randrange(1, 6)))) for i in range(160)]
    docs += [(901, "xyz"), (902, ""), (903, None)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in toxicity.report(docs_of(docs), labels).collect()}
    own = {d: Counter(toxicity.words(t)) for d, t in docs}
    sample = [d for d in range(160) if crc32(str(d).encode()) % 5]
    n = Counter(t for x in own.values() for t in x)

    def unit(d):
        v = {t: (1 + math.log(c)) * (math.log((1 + len(docs)) / (1 + n[t])) + 1)
             for t, c in own[d].items() if any(t in own[e] for e in sample)}
        return {t: x / math.sqrt(sum(y * y for y in v.values())) for t, x in v.items()}
    unit_of = {d: unit(d) for d, _ in docs}
    for d, _ in docs:
        cos = {e: sum(x * unit_of[e].get(t, 0) for t, x in unit_of[d].items()) for e in sample}
        want = sorted((x for x in cos.values() if x > 0), reverse=True)[:toxicity.NEIGHBOURS]
        assert np.allclose(got[d]["cosines"], want, atol=2e-6)
        assert np.allclose([cos[e] for e in got[d]["neighbours"]], want, atol=2e-6)
    assert all(got[d]["neighbours"] for d in range(160)) and not got[901]["neighbours"]


def test_edges(spark, docs_of):
    bad, good = "you idiot fool", "a calm fine day"
    docs = [(i, bad if i % 4 == 0 else good) for i in range(200)] + [(None, bad), (900, None), (901, ""), (902, bad), (902, bad)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(200)] + [(None, 1, "x"), (5, None, "y"), (7, 0, "z")],
                                   "doc_id long, toxic int, text string")
    got = toxicity.report(docs_of(docs), labels).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        if r["doc_id"] is None or r["doc_id"] == 902:
            assert r["predicted"] == 1
        elif r["doc_id"] < 200:
            assert r["predicted"] == (r["doc_id"] % 4 == 0)
    kept = toxicity.without_toxic(docs_of(docs), labels)
    assert kept.columns == docs_of(docs).columns and kept.where("text = 'you idiot fool'").count() == 0
    none = toxicity.report(docs_of(docs), labels.where("doc_id < 0")).collect()
    assert {r["score"] for r in none} == {0.0} and len(none) == len(docs)
    assert toxicity.report(docs_of(docs).where("doc_id < 0"), labels).collect() == []


# I-Match

def test_imatch_pairs(spark, docs_of):
    r = random.Random(5)
    docs = [(i * 3, " ".join(r.choice([f"w{k}" for k in range(80)]) for _ in range(r.randrange(40)))) for i in range(80)]
    docs += [(1000, None), (1001, ""), (1002, docs[4][1]), (None, "w1 w2"), (1002, docs[4][1])]
    got = imatch.report(docs_of(docs)).collect()
    assert len(got) == len(docs)
    line = sorted(((d if d is not None else -1, t or "") for d, t in docs), reverse=True)
    want = []
    for (d, t), (_, u) in zip(line, line[1:] + line[:1]):
        n = len(t)
        want.append((d, n, brute.sha(t[:n - n // 2] + u[:n // 2])))
    assert sorted((-1 if x[0] is None else x[0], x[1], x[2]) for x in got) == sorted(want)
    by_text = {}
    for x in got:
        t = dict(docs)[x["doc_id"]] or ""
        assert by_text.setdefault(t, x["fingerprint"]) == x["fingerprint"]
        assert 0 <= x["near_edited"] <= 1 and 0 <= x["near_next"] <= 1
    assert sum(x["near_edited"] for x in got) > 2 * sum(x["near_next"] for x in got)


def test_imatch_fingerprint_ignores_order_and_terms_outside_the_band():
    band = np.sort(imatch.term_hashes("alpha beta gamma"))
    a, b = imatch.fingerprint("alpha gamma the", band), imatch.fingerprint("Gamma, of ALPHA alpha", band)
    assert imatch.likeness(a, b) == 1 and a.any()
    assert imatch.likeness(a, imatch.fingerprint("", band)) == 0
    assert imatch.likeness(imatch.fingerprint("", band), imatch.fingerprint(" .", band)) == 1


def test_imatch_single_and_empty(docs_of):
    got = imatch.report(docs_of([(4, "abcd")])).collect()
    assert len(got) == 1 and got[0]["edited_sha256"] == brute.sha("abab") and got[0]["near_next"] == 1
    assert imatch.report(docs_of([(4, "abcd")]).where("doc_id = 5")).collect() == []
