import random
import time

import pytest

from leakscope.llm import decontaminate, linededup
from tests.llm import brute


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("seed,run,gram,words", [(1, 3, 2, 50), (2, 2, 1, 50), (3, 4, 2, 5), (4, 5, 3, 3), (5, 3, 2, 2)])
def test_lines_match_brute_force(docs_of, near_texts, seed, run, gram, words):
    docs = near_texts(seed, sep="\n", words=40)

    def longer(t):  # fewer, longer lines
        r = random.Random(t)
        return "".join(c if c != "\n" or r.random() < .4 else " " for c in t)
    docs = [(d, t and longer(t)) for d, t in docs] if words < 50 else docs
    got = linededup.without_repeats(docs_of(docs), run, gram, words)
    assert got.columns == docs_of(docs).columns
    want = [(d, None if k is None else "\n".join(k)) for d, k in brute.lines(docs, run, words)]
    rows = got.collect()
    assert _sorted((r["doc_id"], r["text"]) for r in rows) == _sorted(want)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_line_report(docs_of):
    text = "a\nb\nc\nx\na\nb\nc\ny\nb\nc\nx"
    got = linededup.report(docs_of([(1, text), (2, "a\nb"), (3, None), (4, "")])).collect()
    rows = {r["doc_id"]: r for r in got}
    assert (rows[1]["n_lines"], rows[1]["n_removed"], rows[1]["n_runs"]) == (11, 6, 2)
    assert (rows[2]["n_removed"], rows[3]["n_lines"], rows[4]["n_lines"]) == (0, 0, 1)
    assert rows[1]["kept_sha256"] == brute.sha("a\nb\nc\nx\ny")


def _corpus(near_texts, seed):
    docs = near_texts(seed, words=60)
    items = [(i, " ".join((t or "").split()[3:3 + k])) for i, (_, t), k in
             zip(range(40), docs[5:25] * 2, [13, 5, 40, 20, 0, 1, 14, 30] * 5)]
    return docs, items + [(90, None), (91, ""), (92, "unseen words here"), items[0], (None, "A a1")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contamination_matches_brute_force(spark, docs_of, near_texts, seed):
    docs, items = _corpus(near_texts, seed)
    docs = [x for x in docs if x[0] is not None]
    items = [x for x in items if x[0] is not None]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.decontaminate(docs_of(docs), bench)
    assert _sorted(tuple(r) for r in got.collect()) == _sorted(brute.contamination(docs, items))


def test_both_ways_to_postings_agree(spark, docs_of, near_texts):
    docs, items = _corpus(near_texts, 4)
    bench = spark.createDataFrame([x for x in items if x[0] is not None], "item_id long, text string")
    d = docs_of(docs)
    anch = decontaminate.anchors(bench, d)
    both = [decontaminate.postings(d, anch, few_terms=k) for k in (10 ** 6, 0)]
    few, many = (sorted(map(str, p.where("term IS NOT NULL").drop("first").distinct().collect())) for p in both)
    assert few == many and few
    few, many = (sorted(map(str, p.where("first").select("doc_id", "n_words").collect())) for p in both)
    assert few == many and len(few) == len(docs)


def test_only_ascii_letters_are_lowered(spark, docs_of):
    bench = spark.createDataFrame([(1, "Ärger im straßenbau"), (2, "Été A B")], "item_id long, text string")
    got = decontaminate.decontaminate(docs_of([(1, "ärger im strassenbau"), (2, "ÄRGER IM STRASSENBAU"),
                                               (3, "ÄRGER? Ärger-IM straßenBau"), (4, "été a b Été a B")]), bench)
    assert {r["doc_id"]: r["n_hit"] for r in got.collect()} == {1: 0, 2: 0, 3: 3, 4: 3}


def test_proximity(spark, docs_of):
    docs = docs_of([(1, "one two three rare four five"), (2, "five rare two one three four"), (3, "rare alone")])
    bench = spark.createDataFrame([(7, "one two three rare four five")], "item_id long, text string")
    anch = decontaminate.anchors(bench, docs)
    post = decontaminate.postings(docs, anch)
    assert {r["doc_id"] for r in decontaminate.proximity_matches(post, anch).collect()} == {1, 2}
    assert {r["doc_id"] for r in decontaminate.phrase_matches(post, anch).collect()} == {1}


def test_empty(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = docs_of([(1, "a b"), (None, None)])
    assert {(r["doc_id"], r["n_words"], r["contaminated"]) for r in decontaminate.decontaminate(docs, none).collect()} == {
        (1, 2, False), (None, 0, False)}
    assert decontaminate.decontaminate(docs.where("doc_id = 9"), none).collect() == []
    assert linededup.report(docs.where("doc_id = 9")).collect() == []


def test_main_paths_run_no_python(spark, docs_of):
    docs = docs_of([(1, "a\nb\nc")])
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for df in (linededup.report(docs), decontaminate.decontaminate(docs, bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_a_long_repeated_line_goes(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    two = " ".join(f"v{i}" for i in range(30)) + "\n" + " ".join(f"u{i}" for i in range(30))
    docs = [(1, long), (2, "a\n" + long), (3, two), (4, "b\n" + two + "\nc"), (5, "short line"), (6, "short line")]
    got = {r["doc_id"]: r["text"] for r in linededup.without_repeats(docs_of(docs)).collect()}
    assert got == {1: long, 2: "a", 3: two, 4: "b\nc", 5: "short line", 6: "short line"}


def test_one_very_long_text_takes_linear_time(docs_of):
    took = []
    for n in (10_000, 10_000, 40_000):
        text = "\n".join(f"line {i} of {n}" for i in range(n))
        began = time.time()
        got = linededup.report(docs_of([(1, text), (2, text[:5000])], 1)).collect()
        took.append(time.time() - began)
        assert {r["doc_id"]: r["n_removed"] > 0 for r in got} == {1: False, 2: True}
    assert took[2] < 6 * max(took[1], 2)
