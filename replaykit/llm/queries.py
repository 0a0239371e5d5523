"""The queries of the numbered operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_template, divergence, html_text, language_id, license_scan, merkle, packing, parity_join, poisson_mix, secret_scan, suffix_dedup, token_alignment, turn_repair
from .catalog import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("op1_html_differencing")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extracted(table(spark, sf, "pages"))


@query("op2_parity_join")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return parity_join.near_duplicates(table(spark, sf, "documents"))


@query("op3_best_two_fit")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(table(spark, sf, "documents"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.summary(license_scan.scanned(table(spark, sf, "documents")))


PLANTED = "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"


@query("op5_chat_template")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat_template.digests(rows.unionByName(spark.sql(PLANTED)))


MIXED = f"""
WITH sizes AS (
  SELECT coalesce('s' || source, 'n') AS src, count(*)::DOUBLE AS n FROM documents GROUP BY 1
), rates AS (
  SELECT src, pow(n, {poisson_mix.TEMPERATURE}) / (SELECT sum(pow(n, {poisson_mix.TEMPERATURE})) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes
), cdf AS (
  SELECT src, j, sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (PARTITION BY src ORDER BY j) AS c
  FROM rates, range(0, 80) AS t(j)
), drawn AS (
  SELECT d.*, coalesce('s' || source, 'n') AS src,
    (('0x' || substr(md5('{poisson_mix.SEED}:' || doc_id || ':1'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents d
), counted AS (
  SELECT doc_id, text, lang, source, n_chars, (SELECT count(*) FROM cdf WHERE cdf.src = drawn.src AND cdf.c <= drawn.u) AS k FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, md5('{poisson_mix.SEED + 1}:' || doc_id || ':' || copy) AS shuffle_key
FROM counted, range(0, 80) AS t(copy) WHERE copy < k
"""


@query("op6_poisson_mix", MIXED)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return poisson_mix.replicated(table(spark, sf, "documents"))


@query("op7_merkle_fingerprints")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.with_neighbour_edits(table(spark, sf, "documents").select("doc_id", "text"))


@query("op8_divergence_rules")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    judged = divergence.judged(table(spark, sf, "documents").select("doc_id", "text", "lang"), carried=["doc_id"])
    return judged.selectExpr("row.doc_id AS doc_id", "* EXCEPT (row)")


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf, "documents"))


@query("op10_kneser_ney_languages")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return language_id.predicted(docs, language_id.train(docs))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.aligned(table(spark, sf, "documents"))


# The suffixes' least (cost, initials) from each state, from the last turn to the first; one step a turn for all conversations.
AUDITED = r"""
WITH RECURSIVE drawn AS (
  SELECT coalesce(conv_id::VARCHAR, 'n') AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
    ), 4294967295) % 20 AS draw
  FROM conversations
), damaged AS (
  SELECT k, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_char FROM damaged
), turns AS (
  SELECT *, CASE WHEN last_char = '' THEN 1 WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 2 WHEN last_char NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    substr(role, 1, 1) AS r, lag(substr(role, 1, 1)) OVER (PARTITION BY k ORDER BY i) AS earlier, count(*) OVER (PARTITION BY k) AS n FROM placed
), rest AS (
  SELECT k, n + 1 AS i, {'c': 0, 's': ''} AS v0, {'c': 4, 's': 'II'} AS v1, {'c': 2, 's': 'I'} AS v2, {'c': 0, 's': ''} AS v3 FROM turns GROUP BY k, n
  UNION ALL
  SELECT k, i, list_sort([b0, {'c': 2 + w2.c, 's': 'I' || w2.s}])[1], list_sort([b1, {'c': 2 + w2.c, 's': 'I' || w2.s}])[1], w2, w3 FROM (
    SELECT *, list_sort([b2, {'c': 2 + b3.c, 's': 'I' || b3.s}])[1] AS w2, list_sort([b3, {'c': 2 + b2.c, 's': 'I' || b2.s}])[1] AS w3 FROM (
      SELECT t.k, t.i,
        list_sort([{'c': 3 + v0.c, 's': 'D' || v0.s}, {'c': f + e + CASE r WHEN 's' THEN v1.c WHEN 'u' THEN v2.c ELSE 1000000 END, 's': 'K' || CASE r WHEN 's' THEN v1.s ELSE v2.s END}, {'c': f + e + 2 + v2.c, 's': 'R' || v2.s}])[1] AS b0,
        list_sort([{'c': 3 + v1.c, 's': 'D' || v1.s}, {'c': f + e + CASE r WHEN 'u' THEN v2.c ELSE 1000000 END, 's': 'K' || v2.s}, {'c': f + e + 2 + v2.c, 's': 'R' || v2.s}])[1] AS b1,
        list_sort([{'c': 3 + v2.c, 's': 'D' || v2.s}, {'c': f + e + CASE r WHEN 'a' THEN v3.c ELSE 1000000 END, 's': 'K' || v3.s}, {'c': f + e + 2 + v3.c, 's': 'R' || v3.s}])[1] AS b2,
        list_sort([{'c': 3 + v3.c, 's': 'D' || v3.s}, {'c': f + e + CASE r WHEN 'u' THEN v2.c ELSE 1000000 END, 's': 'K' || v2.s}, {'c': f + e + 2 + v2.c, 's': 'R' || v2.s}])[1] AS b3
      FROM (SELECT *, CASE WHEN fault IN (1, 2) THEN 1000000 ELSE 0 END AS f, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS e FROM turns) t
      JOIN rest ON rest.k = t.k AND rest.i = t.i + 1
    )
  )
), best AS (
  SELECT k, v0.c AS cost, v0.s AS audit FROM rest WHERE i = 1
), letters AS (
  SELECT k, p, audit[p] AS edit, (SELECT count(*) FROM range(1, p + 1) AS g(j) WHERE audit[j] <> 'I') AS i, (SELECT count(*) FROM range(1, p + 1) AS g(j) WHERE audit[j] <> 'D') AS place
  FROM best, range(1, length(audit) + 1) AS g(p)
), shown AS (
  SELECT l.k, l.p, l.place, l.edit, t.role, CASE WHEN l.edit = 'I' THEN '' ELSE t.text END AS text,
    max(CASE WHEN l.place = 1 AND l.edit = 'K' AND t.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.k) AS system
  FROM letters l LEFT JOIN turns t ON t.k = l.k AND t.i = l.i AND l.edit <> 'I' WHERE l.edit <> 'D'
), texts AS (
  SELECT k, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS whole FROM shown GROUP BY k
), figures AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND earlier || r NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY k
)
SELECT DISTINCT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM drawn d LEFT JOIN figures USING (k) LEFT JOIN best USING (k) LEFT JOIN texts USING (k)
"""


@query("op12_turn_repair", AUDITED)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return turn_repair.audited_after_damage(table(spark, sf, "conversations"))


# A span starts behind the pieces and matches before it, which the text falls into when it is split at the matches.
SECRETS = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS owner, coalesce('=' || doc_id, '') AS repository, coalesce(text, '') AS x FROM documents
), patterns(kind, pattern, grp, least) AS (
  VALUES (0, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1, {secret_scan.LEAST_VALUE}),
    (1, '(AKIA[A-Z0-9]+)', 1, {secret_scan.LEAST_ACCESS}), (2, '([0-9a-f]+)', 1, {secret_scan.LEAST_HEX}), (3, '([A-Za-z0-9+/_-]+)', 1, {secret_scan.LEAST_KEY})
), cut AS (
  SELECT rid, kind, least, string_split_regex(x, pattern) AS parts, regexp_extract_all(x, pattern, 0) AS whole, regexp_extract_all(x, pattern, 1) AS val
  FROM texts, patterns WHERE regexp_matches(x, pattern)
), ends AS (
  SELECT rid, kind, least, unnest(whole) AS m, unnest(val) AS v, unnest(list_transform(parts, lambda p: length(p))[:len(whole)]) AS gap, generate_subscripts(whole, 1) AS k FROM cut
), spans AS (
  SELECT rid, kind, least, v, (sum(gap + length(m)) OVER w - length(m))::BIGINT AS s, (sum(gap + length(m)) OVER w)::BIGINT AS e
  FROM ends WINDOW w AS (PARTITION BY rid, kind ORDER BY k)
), long AS (
  SELECT * FROM spans WHERE length(v) >= least
), base AS (
  SELECT rid, kind, v, s, e FROM long WHERE kind < 3
), found AS (
  SELECT * FROM base UNION ALL
  SELECT rid, kind, v, s, e FROM long r WHERE kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
    AND len(list_distinct(string_split(v, ''))) >= {secret_scan.LEAST_DIFFERENT} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.s < r.e AND b.e > r.s)
), held AS (
  SELECT v, count(DISTINCT owner) AS owners FROM found JOIN texts USING (rid) GROUP BY v
), judged AS (
  SELECT f.*, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e AS shown, CASE WHEN owners >= {secret_scan.EXAMPLE_OWNERS} THEN 'example' WHEN owners = 1 THEN 'live' ELSE 'shared' END AS verdict
  FROM found f JOIN held USING (v)
)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(shown, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg(shown, ',' ORDER BY s, kind), '') AS spans,
  count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'shared') AS n_shared, count(*) FILTER (verdict = 'example') AS n_example
FROM texts t LEFT JOIN (SELECT * FROM judged WHERE kind < 3 OR verdict = 'live') j USING (rid) GROUP BY t.rid, t.doc_id
"""


@query("op13_secret_scan", SECRETS)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.summary(table(spark, sf, "documents"))
