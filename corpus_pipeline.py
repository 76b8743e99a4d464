"""The corpus pipeline: toxic documents go, repeated line runs go, one document
of each SimHash group stays, documents contaminated by the benchmark go, and
what is left is encoded. Every stage's result is written to the shared folder
and reread; a rerun after a lost driver starts from the inputs.

SQL cannot express the toxicity model, SimHash's hashes or the encoding, so
``ORACLE_SQL`` is None and ``run`` is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leakscope.llm import decontaminate, linededup, pieces, simhash, toxicity
from leakscope.llm.common import null_safe, table, written
from leakscope.llm.queries import TOKENIZERS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = written(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return null_safe(docs, bad, "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines),
          ("SimHash near-dedup", drop_near_duplicates), ("benchmark decontamination", drop_contaminated),
          ("SentencePiece encoding and decoding", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
