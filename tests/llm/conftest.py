import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents table from (doc_id, text) pairs, with columns whose names
    clash with the operators' own and nulls in all others."""
    def make(pairs, parts=3):
        rows = [(d, t, None, None, None if t is None else len(t), 1, "x", None) for d, t in pairs]
        return spark.createDataFrame(rows, SCHEMA + ", d long, fp string, spans string").repartition(parts)
    return make


@pytest.fixture()
def near_texts():
    """Texts with copies, edits, shared passages, nulls, ties and repeated rows."""
    def make(seed, sep=" ", n=30, size=(0, 3, 30, 90), words=300):
        r = random.Random(seed)
        vocab = ["ab"[r.randrange(2)] * r.randint(1, 2) + str(i) + r.choice(["", "é", "Ä", "."]) for i in range(words)]
        base = [[r.choice(vocab) for _ in range(r.choice(size))] for _ in range(6)]
        out = [(None, None), (5, ""), (7, " \t\n"), (None, "A"), (9, None)]
        for i in range(n):
            x = list(r.choice(base))
            if x and r.random() < .5:
                x[r.randrange(len(x))] = r.choice(vocab)
            y = list(r.choice(base))
            k = r.randint(0, len(y))
            out.append((100 + i, sep.join(x + y[k:] if r.random() < .5 else y[:k] + x)))
        out += [out[8], out[8], (500, out[8][1]), (501, sep.join(vocab[i % min(7, len(vocab))] for i in range(4000)))]
        return out
    return make
