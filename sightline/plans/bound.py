"""The bound tables that queries share, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import citations, mentions, sentiment
from ..sources import tables

# Shared SQL. W is any character that ends a word; a first position is the length of what stands before.
ANSWERS = """answers AS (
  SELECT source AS run_id, doc_id AS answer_id, doc_id AS sequence, coalesce(text, '') AS t, CASE WHEN lang = 'en' THEN 'generic'
    ELSE 'branded' END AS question_type,
         CASE doc_id % 3 WHEN 0 THEN 'decision' WHEN 1 THEN 'comparison' ELSE 'recommendation' END AS funnel_intent, coalesce(trim(text) <> '',
           false) AS valid FROM documents),
objects(object_id, role, display_order, alias) AS (VALUES ('target', 'target', 0, 'attion'), ('competitor-01', 'competitor', 1, 'erble'),
  ('competitor-02', 'competitor', 2, 'ertion'), ('competitor-03', 'competitor', 3, 'orre')),
runs AS (SELECT DISTINCT run_id FROM answers WHERE run_id IS NOT NULL),
found AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, answer_id ORDER BY first_position, display_order) AS report_rank FROM (
    SELECT run_id, answer_id, object_id, display_order,
      length(regexp_extract(t, '(?is)^((?:.*?[^\\p{L}\\p{N}_])??)(' || alias || ')(?:[^\\p{L}\\p{N}_]|$)', 1)) AS first_position
    FROM answers, objects WHERE run_id IS NOT NULL AND regexp_matches(t, '(?i)(^|[^\\p{L}\\p{N}_])' || alias || '([^\\p{L}\\p{N}_]|$)')))"""

METRICS = """metrics AS (
  SELECT r.run_id, o.object_id, o.role, o.display_order, coalesce(a.n, 0) AS answers, coalesce(m.n, 0) AS mentions, coalesce(m.s, 0) AS rank_sum,
         CAST(sum(coalesce(m.n, 0)) OVER (PARTITION BY r.run_id) AS BIGINT) AS all_mentions
  FROM runs r CROSS JOIN objects o
  LEFT JOIN (SELECT run_id, count(*) AS n FROM answers WHERE question_type = 'generic' GROUP BY run_id) a ON a.run_id = r.run_id
  LEFT JOIN (SELECT f.run_id, f.object_id, count(*) AS n, CAST(sum(report_rank) AS BIGINT) AS s FROM found f
    JOIN answers g ON g.run_id = f.run_id AND g.answer_id = f.answer_id WHERE g.question_type = 'generic'
    GROUP BY ALL) m ON m.run_id = r.run_id AND m.object_id = o.object_id)"""

PAGES = """raw AS (
  SELECT page_id // 4 AS answer_id, 'run' || CAST(page_id // 40000 AS VARCHAR) AS run_id, page_id % 4 + 1 AS citation_no, url,
         regexp_replace(rtrim(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '.'), '^www\\.', '') AS host,
         regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(str_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_'))) AS q
           FROM pages),
classified AS (
  SELECT *, lower(regexp_extract(url, '^([^:]*)', 1)) || '://' || host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&')
    ELSE '' END AS canonical_url,
         array_to_string(str_split(host, '.')[-2:], '.') AS registrable_domain,
         CASE WHEN host = 'example.com' OR ends_with(host, '.example.com') THEN 'brand_official'
           WHEN host = 'example.net' OR ends_with(host, '.example.net') THEN 'competitor_official' ELSE 'other' END AS source_type FROM raw),
firsts AS (SELECT * FROM classified QUALIFY row_number() OVER (PARTITION BY run_id, answer_id, canonical_url ORDER BY citation_no) = 1)"""

JUDGED = """judged AS (
  SELECT doc_id AS answer_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label, doc_id % 2 + 1 AS attempt,
         CASE WHEN 0.5::DOUBLE + (doc_id % 50) / 100.0::DOUBLE >= 0.75 THEN 'accepted' WHEN doc_id % 2 + 1 < 2 THEN 'review' ELSE 'unresolved' END AS status
           FROM labels)"""


def found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = tables.answers(spark, sf_dir)
    objects = tables.objects(rows)
    return rows, objects, mentions.mentions(rows, mentions.alias_patterns(objects))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, objects, named = found(spark, sf_dir)
    return mentions.object_metrics(rows, named, objects)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = tables.citations(spark, sf_dir)
    return citations.classify(citations.canonical(cited), tables.domains(cited))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = tables.answers(spark, sf_dir).select("run_id", "answer_id")
    return sentiment.routed(tables.sentiment_results(spark, sf_dir), 0.75).join(runs, "answer_id")
