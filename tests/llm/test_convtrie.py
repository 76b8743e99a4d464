import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from leakscope.llm import convtrie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, x1 string, digest int"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def turns_of(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(*r, None, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return make


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, w in whole.items():
        for d in range(len(w) + 1):
            nodes[w[:d]].append(c)
    kids = defaultdict(list)
    for w in nodes:
        if w:
            kids[w[:-1]].append(w)
    leaves, saved = {}, {}
    for w in sorted(nodes, key=len, reverse=True):
        leaves[w] = sum(leaves[k] for k in kids[w]) or (not kids[w]) * 1
        saved[w] = sum(saved[k] for k in kids[w]) + ((len(nodes[w]) - 1) * len(w[-1][1].encode()) if w else 0)
    return sorted(((min(m), len(w), min(nodes[w[:-1]]) if w else None, len(m), len(kids[w]), leaves[w], saved[w],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if whole[c] == w))).encode()).hexdigest())
                   for w, m in nodes.items()), key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


def _cases(seed, n):
    r = random.Random(seed)
    say = lambda: (r.choice(["user", "assistant", None, ""]), r.choice(["a", "bé", "ccc", "", None, "x" * 40]))
    base = [[say() for _ in range(r.choice([1, 3, 12, 30]))] for _ in range(6)]
    rows = []
    for c in r.sample(range(-40, 400), n):
        b = r.choice(base)
        t = b[:r.randint(1, len(b))] + [say() for _ in range(r.choice([0, 0, 1, 4]))]
        rows += [(c, r.choice([i, i, i, None, 0]), *x) for i, x in enumerate(t)]
    return rows + [(None, 1, "user", "lost"), (500, 1, "user", "a"), (500, 1, "user", "a"), (500, 1, None, None)] + rows[:3]


@pytest.mark.parametrize("seed,n,batch,cut", [(1, 30, 256, 4096), (2, 120, 2, 7), (3, 200, 1, 1), (4, 150, 8, 20)])
def test_equals_brute_force(turns_of, monkeypatch, seed, n, batch, cut):
    rows = _cases(seed, n)
    assert got(T.report(turns_of(rows), batch, cut)) == brute(rows)


def test_long_conversations_are_cut_into_units(turns_of, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    rows = _cases(5, 60)
    assert got(T.report(turns_of(rows), 3, 5)) == brute(rows)
    monkeypatch.setattr(T, "CHUNK", 100)
    rows = [(c, i, "u", f"{i % 3}" + "!" * (i == 4000 + c)) for c in range(3) for i in range(4500)]  # one very long way
    assert got(T.report(turns_of(rows), 3, 5)) == brute(rows)


def test_copies_ties_and_empty(turns_of):
    copies = [(5 * c, 0, "user", "same") for c in range(300)]
    assert got(T.report(turns_of(copies), 4, 16)) == brute(copies)
    lonely = [(c, 0, "user", "x") for c in range(1, 60)]       # no base: some are rebuilt without a turn
    assert got(T.report(turns_of(lonely))) == brute(lonely)
    assert T.report(turns_of(copies).where("conv_id < 0")).collect() == []
    assert T.report(turns_of([(None, 1, "a", "b")])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_local_trie_finds_exit_nodes(seed):
    r = random.Random(seed)
    words = [tuple(r.choice("ab") for _ in range(r.randint(1, 24))) for _ in range(120)]
    prefixes = lambda w: [(hash(w[:d + 1]), d) for d in range(len(w))]
    trie = T.ZFastTrie()
    done = set()
    for w in words[:80]:
        trie.insert(prefixes(w))
        done.add(w)
    known = {w[:d] for w in done for d in range(len(w) + 1)}
    forks = {p for p in known if p and (p in done or len({w[len(p)] for w in done if w[:len(p)] == p and len(w) > len(p)}) > 1)}
    assert set(trie.nodes()) == {(len(p), prefixes(p)[-1]) for p in forks}
    assert len(trie.handles) == len(forks)
    for w in words:
        want = max(d for d in range(len(w) + 1) if w[:d] in known)
        assert trie.exit(prefixes(w))[1] == want
