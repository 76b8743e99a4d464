import random

from leakscope.llm import chat


def _brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t, r, x))
    convs = {c: [y[1:] for y in sorted(v, key=lambda y: tuple((z is not None, z) for z in y))] for c, v in convs.items()}
    out = []
    for c, turns in convs.items():
        same = [d for d, u in convs.items() if u == turns]
        longer = any(len(u) > len(turns) and u[:len(turns)] == turns for u in convs.values())
        if not longer and c == min(same, key=lambda z: (z is None, z)):
            text = "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in turns)
            out.append((c, len(turns), len(same), text))
    return out


def test_collapse_matches_brute_force(spark):
    r = random.Random(1)
    rows = []
    for c in range(120):
        talk = [(("user", "assistant")[i % 2], f"t{r.randrange(2)}") for i in range(r.randrange(1, 6))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(talk)]
    rows += [(500, 0, None, None), (501, 0, "", ""), (502, 0, None, ""), (502, 1, "user", None), (None, 0, "user", "odd"),
             (503, None, "user", "odd"), rows[0], rows[0]]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, whole int")
    got = sorted(map(tuple, chat.maximal(df.repartition(5)).collect()), key=str)
    assert got == sorted(_brute(rows), key=str)
    assert chat.maximal(df.where("turn = -1")).collect() == []
