import random
import tracemalloc

import pytest
import sentencepiece

from leakscope.llm import pieces
from leakscope.llm.queries import TOKENIZERS
from tests.llm.brute import sha

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
ALPHABET = "ab ▁  \n\té日🙂<s>0x⁇�\x00'Äß1"


@pytest.fixture(scope="module")
def both():
    with open(MODEL, "rb") as f:
        return pieces.Encoder(f.read()), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _texts(n, size):
    r = random.Random(n)
    return ["", " ", "  ", "▁", "a" * 500, "日" * 300, "the same the same " * 200] + [
        "".join(r.choice(ALPHABET) for _ in range(r.randrange(size))) for _ in range(n)]


def test_encode_and_decode_like_the_library(both):
    enc, lib = both
    for t in _texts(1500, 14) + _texts(60, 400):
        ids = lib.encode(t, add_eos=True)
        got, begin, end = enc.encode(t)
        assert got == ids and enc.decode(ids) == lib.decode(ids), t
        n, h, d, covered = enc.digest(t)
        assert (n, h, d) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
        assert covered == len(t.encode())
        # spans are in order, without gaps, and hold what the piece says
        assert [*begin[1:], end[-1]] == end and end[-1] == len(t.encode())
        for i, b, e in zip(got, begin, end):
            p, _, kind = enc.pieces[i]
            if kind == pieces.NORMAL and b:
                assert t.encode()[b:e].decode().replace(" ", "▁") == p


def test_normaliser_follows_a_compiled_map():
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = dict(pieces._fields(lib.serialized_model_proto()))[3]
    norm = pieces.Normaliser(spec)
    norm.trim = norm.prefix = norm.escape = False
    lib2 = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", remove_extra_whitespaces=False,
                                                 escape_whitespaces=False, add_dummy_prefix=False)
    r = random.Random(4)
    alpha = "aé éﬁＡ①㍿​ 　ｶﾞ가각가xyz"
    for _ in range(800):
        t = "".join(r.choice(alpha) for _ in range(r.randrange(12)))
        got, at = norm(t)
        assert got == lib2.normalize(t), t
        assert len(at) == len(got) + 1 and at == sorted(at) and at[-1] == len(t.encode())


def test_rows(docs_of, both):
    docs = [(None, None), (1, ""), (2, None), (3, "Été  x"), (3, "Été  x"), (4, "a" * 20000)]
    lib = both[1]
    want = sorted((str(d), len(i := lib.encode(t or "", add_eos=True)), sha(" ".join(map(str, i))), sha(lib.decode(i)))
                  for d, t in docs)
    got = pieces.digests(docs_of(docs), MODEL).collect()
    assert sorted((str(r[0]), *r[1:4]) for r in got) == want
    full = pieces.encode(docs_of(docs), MODEL).collect()
    assert sorted((str(r["doc_id"]), len(r["ids"])) for r in full) == [w[:2] for w in want]
    assert pieces.digests(docs_of(docs).where("doc_id = 99"), MODEL).collect() == []


def test_rows_carry_the_spans_of_their_pieces(docs_of, both):
    enc, lib = both
    docs = [(i, t) for i, t in enumerate([None, *_texts(120, 60)])]
    got = {r["doc_id"]: r for r in pieces.digests(docs_of(docs), MODEL).collect()}
    for d, t in docs:
        b = len((t or "").encode())
        ids, begin, end = enc.encode(t)
        assert got[d]["spans_sha256"] == sha(b"".join(x.to_bytes(8, "little") for s in zip(begin, end) for x in s))
        assert got[d]["covered_bytes"] == len(set().union(*map(range, begin, end))) == b and ids[-1] == enc.eos


def test_alignment_without_a_map_is_that_of_the_general_way(both):
    norm = both[0].normalise
    for t in _texts(300, 40):
        assert norm(t) == norm.mapped(t), t


def test_a_remembered_chunk_takes_few_bytes(both):
    with open(MODEL, "rb") as f:
        enc = pieces.Encoder(f.read())
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("abcdeéno") for _ in range(r.randrange(3, 12))) for _ in range(500)) for _ in range(20)]
    rows = [enc.row(t) for t in texts[:1]]
    tracemalloc.start()
    try:
        n, before = len(enc.memo), tracemalloc.get_traced_memory()[0]
        rows += [enc.row(t) for t in texts[1:]]
        held = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert len(enc.memo) - n > 5000
    assert held < 300 * (len(enc.memo) - n)
    for t, row in zip(texts, rows):
        ids = both[1].encode(t, add_eos=True)
        assert row[:3] == (len(ids), sha(" ".join(map(str, ids))), sha(both[1].decode(ids)))
