import random

import numpy as np
import pytest

from leakscope.llm import repeats, substring, suffixes
from tests.llm import brute


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("width", [1, 2, 3, 7, 16])
def test_sliding_min_takes_the_rightmost(width):
    v = np.array([random.Random(width).randrange(4) for _ in range(60)], np.uint64)
    got = repeats.sliding_min(v, width)
    for i, at in enumerate(got):
        w = v[i:i + width].tolist()
        assert at == i + max(k for k in range(width) if w[k] == min(w))


def test_gram_hashes_depend_on_the_gram_only():
    r = np.random.default_rng(1)
    v = r.integers(1, 5, 400).astype(np.uint64)
    for gram in (1, 2, 3, 6, 13, 40):
        h = repeats.gram_hashes(v, gram)
        assert len(h) == len(v) - gram + 1
        seen = {}
        for i in range(len(h)):
            assert seen.setdefault(tuple(v[i:i + gram].tolist()), h[i]) == h[i]


@pytest.mark.parametrize("seed,length,crowded", [(1, 20, 1000), (2, 7, 2), (3, 4, 1)])
def test_substring_matches_brute_force(docs_of, near_texts, seed, length, crowded):
    docs = near_texts(seed, words=(5 if seed == 3 else 300))
    got = substring.dedup(docs_of(docs), length, min(3, length - 1), crowded)
    got = [tuple(r) for r in got.collect()]
    assert _key(got) == _key(brute.substring(docs, length))


@pytest.mark.parametrize("seed,length,crowded", [(1, 200, 3000), (2, 33, 2), (3, 40, 4)])
def test_suffixes_match_brute_force(docs_of, near_texts, seed, length, crowded):
    docs = near_texts(seed, words=(5 if seed == 3 else 300))
    docs = [x for x in docs if x[0] is not None]
    got = suffixes.dedup(docs_of(docs), length, 12, crowded)
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()]
    assert _key(got) == _key(brute.suffixes(docs, length))


def test_empty_tables(spark, docs_of):
    empty = docs_of([(1, "a")]).where("doc_id < 0")
    assert substring.dedup(empty).collect() == [] == suffixes.dedup(empty).collect()


def test_loser_tree_merges_with_right_prefixes():
    r = random.Random(3)
    for _ in range(40):
        runs = [sorted({bytes(r.choice(b"ab") for _ in range(r.randrange(9))) for _ in range(r.randrange(12))})
                for _ in range(r.randrange(1, 7))]
        coded = [[suffixes.encode_block([(s, (1, 2, 3, 4, 0)) for s in x[i:i + 3]]) for i in range(0, len(x), 3)] for x in runs]
        last, out = b"", []
        for s, h, meta in suffixes.LoserTree([suffixes.read_run(x) for x in coded]):
            assert meta == (1, 2, 3, 4, 0)
            if out:
                assert h == suffixes.shared(last, s, 0)
            out.append(s)
            last = s
        assert out == sorted(s for x in runs for s in x)
