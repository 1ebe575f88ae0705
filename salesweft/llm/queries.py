"""Queries of the operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesweft.llm import chat_format, exact_dedup, hard_negatives, language_id, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules, ranked_search, secret_scan, warc
from salesweft.llm.columns import table
from salesweft.session import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    @functools.wraps(function)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        importable(spark)
        return function(spark, sf)

    QUERIES[function.__name__] = run
    return run


@query
def op1_quality_classifier(spark, sf):
    return quality_model.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op2_ngram_jaccard_join(spark, sf):
    return ngram_join.joined(table(spark, sf, "documents")).drop("row")


@query
def op3_warc(spark, sf):
    return warc.round_trip(spark, table(spark, sf, "pages"))


SQL["op3_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS newest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM q"""


@query
def op4_best_fit_packing(spark, sf):
    return packing.packed_documents(table(spark, sf, "documents"))


MIX = {"clean": 0.7, "low": 0.2, "toxic": 0.1}


@query
def op5_mixing(spark, sf):
    return mixing.mixing_rates(table(spark, sf, "documents"), mixing.label_domains(table(spark, sf, "labels")), MIX)


@query
def op6_line_dedup(spark, sf):
    return line_dedup.removed_lines(table(spark, sf, "documents")).drop("source_row")


@query
def op7_secret_scan(spark, sf):
    return secret_scan.secret_counts(table(spark, sf, "documents"))


@query
def op8_language_id(spark, sf):
    return language_id.language_ids(table(spark, sf, "documents"))


@query
def op9_quality_rules(spark, sf):
    return quality_rules.quality_rules(table(spark, sf, "documents"))


@query
def op10_exact_dedup(spark, sf):
    return exact_dedup.decisions(table(spark, sf, "documents")).drop("row")


SQL["op10_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d"""


@query
def op11_ranked_search(spark, sf):
    return ranked_search.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL["op11_ranked_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
o AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
p AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)) AS impact
  FROM t, c),
s AS (
  SELECT item_id, doc_id, CAST(sum(weight * impact) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term) GROUP BY item_id, doc_id HAVING sum(weight * impact) > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""


@query
def op12_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""


# One more conversation, whose texts hold the control strings themselves.
MARKED = r"\### Assistant: </turn> ok"


@query
def op13_chat_formatting(spark, sf):
    rows = table(spark, sf, "conversations")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    marked = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(MARKED).alias("text"))
    return chat_format.digests(rows.select(*marked.columns).unionByName(marked))


SQL["op13_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
w AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '<', '\l'), ':', '\c') AS head,
         replace(replace(replace(text, '\', '\\'), '</turn>', '\l/turn>'), '### ', '\h## ') AS safe,
         bool_or(contains(text, '### ') OR contains(text, '</turn>') OR contains(text, '\\')
                 OR contains(text, '\h') OR contains(text, '\l') OR contains(text, '\c')) OVER (PARTITION BY conv_id) AS clash
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS LAST, role, text), '') AS loss,
         CAST(sum(length(head) + 14 + length(CASE WHEN clash THEN safe ELSE text END)) AS BIGINT) AS formatted_chars
  FROM w GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g"""
