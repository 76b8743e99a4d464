"""Registered queries of the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leakscope.llm import (centroids, chat, convtrie, decontaminate, hmm, imatch, linededup, oracle_sql, pieces, simhash,
                           substring, suffixes, toxicity, urltree)
from leakscope.llm.common import table

#: Folder of the public tokenizers' files.
TOKENIZERS = os.path.dirname(public_tokenizers.path("piece_bpe_32k.model"))


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.report(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), f"{tokenizers}/piece_bpe_32k.model")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal(table(spark, sf_dir, "conversations"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(table(spark, sf_dir, "pages"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_imatch, op2_line_dedup, op3_substring_dedup, op4_hmm, op5_sentencepiece,
                            op6_suffix_array, op7_toxicity, op8_chat, op9_simhash, op10_decontamination,
                            op11_url_filters, op12_centroid_clustering, op13_conversation_trie)}

LINE_RUN = linededup.MIN_RUN
SUB_WORDS = substring.LENGTH

ORACLES: dict[str, str] = {
    "op2_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l,
             list_transform(string_split(text, chr(10)), lambda x: length(x) - length(replace(x, ' ', '')) + 1) AS c FROM documents),
e AS (SELECT doc_id, l, c, unnest(range(1, len(l) + 1)) AS s FROM d),
w AS (SELECT doc_id, s, m, array_to_string(list_slice(l, s, s + m - 1), chr(10)) AS k FROM (
      SELECT doc_id, l, s, {LINE_RUN} AS m FROM e WHERE s + {LINE_RUN - 1} <= len(l) UNION ALL
      SELECT doc_id, l, s, CASE {" ".join(f"WHEN s + {k - 1} <= len(l) AND list_sum(list_slice(c, s, s + {k - 1})) >= {linededup.MIN_WORDS} THEN {k}" for k in range(1, LINE_RUN))} END AS m FROM e)
      WHERE m IS NOT NULL),
later AS (SELECT doc_id, s, m FROM w
          QUALIFY row_number() OVER (PARTITION BY k, m ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS i FROM later),
runs AS (SELECT doc_id, count(*) AS n_removed, list(i ORDER BY i) AS g,
                count(*) FILTER (WHERE first) AS n_runs
         FROM (SELECT doc_id, i, i - 1 IS DISTINCT FROM lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS first
               FROM gone) GROUP BY doc_id),
kept AS (SELECT d.doc_id, string_agg(u.line, chr(10) ORDER BY u.i) AS t
         FROM d, LATERAL (SELECT unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i) u
         LEFT JOIN gone ON gone.doc_id = d.doc_id AND gone.i = u.i WHERE gone.i IS NULL GROUP BY d.doc_id)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op3_substring_dedup": rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                  lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + {SUB_WORDS - 1}), ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SUB_WORDS - 2})) AS s FROM d)),
later AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {SUB_WORDS})) AS i FROM later),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (SELECT u.doc_id, string_agg(u.x, ' ' ORDER BY u.i) AS t
         FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) u
         LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.i = u.i WHERE gone.i IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op8_chat": """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
r AS (SELECT conv_id, turn, row_number() OVER w AS i,
             string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '')
             OVER w AS so_far, string_agg(concat(role IS NULL, length(role), ':', role, text IS NULL, length(text), ':', text), '')
             OVER w AS exact, count(*) OVER (PARTITION BY conv_id) AS n
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT exact, min(conv_id) AS conv_id, count(*) AS n_copies FROM r WHERE i = n GROUP BY exact)
SELECT whole.conv_id, n AS n_turns, n_copies, so_far AS rendered
FROM whole JOIN r ON r.conv_id = whole.conv_id AND r.i = r.n
WHERE whole.exact NOT IN (SELECT exact FROM r WHERE i < n)""",
    "op10_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bx AS (SELECT DISTINCT item_id, least(13, len(w)) AS k,
              array_to_string(list_slice(w, s, s + least(13, len(w)) - 1), ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM bw WHERE len(w) > 0)),
dx AS (SELECT doc_id, s, k, array_to_string(list_slice(w, s, s + k - 1), ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
             FROM dw, (SELECT DISTINCT k FROM bx))),
hit AS (SELECT doc_id, s, dx.k, item_id FROM dx JOIN bx ON dx.t = bx.t AND dx.k = bx.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op11_url_filters": oracle_sql.urls(),
    "op12_centroid_clustering": oracle_sql.clusters(),
    "op13_conversation_trie": oracle_sql.trie(),
}
