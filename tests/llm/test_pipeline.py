import corpus_pipeline
import __spark_entry__
from leakscope.llm.common import table
from leakscope.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [f"op{i}" for i in range(1, 14)] == sorted((k.split("_")[0] for k in QUERIES), key=lambda k: int(k[2:]))
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    last = len(corpus_pipeline.STAGES) - 1
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = _pairs(docs)
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), f"test-{k}")
        if k == last:
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(d for d, _ in before)
            break
        assert docs.columns == COLUMNS
        after = sorted(_pairs(docs))
        if name == "toxicity":
            assert set(after) <= set(before) and len(after) >= 0.8 * len(before)
        elif name == "line dedup":
            assert after == sorted((d, "\n".join(x)) for d, x in brute.lines(before, 3))
        elif name == "SimHash near-dedup":
            groups = brute.simhash_groups(before)
            assert [d for d, _ in after] == sorted({c for _, _, c in groups})
        else:
            bad = {r[0] for r in brute.contamination(before, items) if r[5]}
            assert after == sorted(x for x in before if x[0] not in bad)




def test_clashing_rows_through_the_whole_pipeline(spark, monkeypatch, tmp_path):
    """Nulls in any column, repeated rows, ids that name several texts, extra
    columns with clashing names, an empty table."""
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(i, say(i), None, "s", None, 1, "x") for i in range(30)]
    rows += [rows[3], rows[3], (5, say(3), None, None, None, None, None), (None, say(77), None, None, None, None, None),
             (None, say(4), None, None, None, None, None), (None, None, None, None, None, None, None), (90, "", "", "", 0, 0, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id string"
    for name, own in (("full", rows), ("empty", [])):
        d = str(tmp_path / name)
        spark.createDataFrame(own, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)] + [(None, None)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, say(7)), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
        got = [r["decoded_sha256"] for r in out.collect()]
        assert bool(got) == bool(own) and len(got) <= len(own)
        if own:
            assert got.count(brute.sha(say(3))) <= 1
