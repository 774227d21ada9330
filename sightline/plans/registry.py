"""Registered queries of the library's operators over the bound tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text, urls
from ..operators import bank, citations, grounding, mentions, results, sampling, sentiment
from ..operators import imports as operators_imports
from ..sources import ingest, tables
from . import banks, files, imports, outcomes, raw, reports  # noqa: F401 - they register their queries
from .bound import ANSWERS as _ANSWERS
from .bound import JUDGED as _JUDGED
from .bound import METRICS as _METRICS
from .bound import PAGES as _PAGES
from .bound import classified as _classified
from .bound import found as _found
from .bound import judged as _judged
from .bound import metrics as _metrics
from .register import ORACLE, QUERIES, query  # noqa: F401

@query(f"""WITH {_ANSWERS}, {_METRICS}
SELECT run_id, object_id, answers, mentions, all_mentions, CASE WHEN answers > 0 THEN CAST(mentions AS DOUBLE) / answers END AS mention_rate,
       CASE WHEN answers > 0 THEN CAST((200 * mentions + answers) // (2 * answers) AS VARCHAR) || '%' ELSE '—' END AS mention_display,
       CASE WHEN all_mentions > 0 THEN CAST(mentions AS DOUBLE) / all_mentions END AS share_of_voice, CASE
         WHEN mentions > 0 THEN CAST(rank_sum AS DOUBLE) / mentions END AS average_rank,
       CASE WHEN mentions > 0 THEN '#' || CAST(((20 * rank_sum + mentions) // (2 * mentions)) // 10 AS VARCHAR) || '.' || CAST(((20 * rank_sum + mentions) // (2 * mentions)) % 10 AS VARCHAR) ELSE '—' END AS rank_display FROM metrics""")
def mention_metrics(spark, sf_dir):
    """A1-A3, F12."""
    return _metrics(spark, sf_dir).select(
        "run_id", "object_id", "answers", "mentions", "all_mentions", "mention_rate", "mention_display", "share_of_voice", "average_rank", "rank_display"
    )


@query(f"WITH {_ANSWERS} SELECT run_id, answer_id, object_id, first_position, report_rank FROM found")
def mention_ranks(spark, sf_dir):
    """J5, W2."""
    return _found(spark, sf_dir)[2].select(
        "run_id", "answer_id", "object_id", F.col("first_position").cast("long").alias("first_position"), F.col("report_rank").cast("long").alias("report_rank")
    )


@query(rf"""WITH {_ANSWERS}, cut AS (SELECT run_id, answer_id, regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS w FROM answers
  WHERE run_id IS NOT NULL),
words AS (SELECT run_id, answer_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM cut),
placed AS (SELECT *, sum(length(w)) OVER (PARTITION BY run_id, answer_id ORDER BY i) AS stop FROM words)
SELECT run_id, answer_id, object_id, alias, w AS matched_text, CAST(stop - length(w) AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end" FROM placed
  JOIN objects ON lower(w) = alias""")
def mention_spans(spark, sf_dir):
    """Every span of every object, with code-point offsets."""
    rows = tables.answers(spark, sf_dir)
    found = mentions.mention_spans(rows, mentions.alias_patterns(tables.objects(rows))).select(
        "run_id", "answer_id", "object_id", F.explode("spans").alias("s")
    )
    return found.select(
        "run_id", "answer_id", "object_id", "s.alias", "s.matched_text", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end")
    )


@query(f"""WITH {_ANSWERS} SELECT f.run_id, object_id, f.answer_id FROM found f JOIN answers a ON a.run_id = f.run_id AND a.answer_id = f.answer_id
  WHERE question_type = 'generic'""")
def mention_lineage(spark, sf_dir):
    """A31."""
    rows, _, found = _found(spark, sf_dir)
    return mentions.mention_lineage(rows, found)


@query(f"WITH {_PAGES} SELECT run_id, answer_id, citation_no, canonical_url, host, registrable_domain, source_type FROM classified")
def citation_classes(spark, sf_dir):
    """F5-F7, J6, J7, P9, P10."""
    return _classified(spark, sf_dir).select(
        "run_id", "answer_id", F.col("citation_no").cast("long").alias("citation_no"), "canonical_url", "host", "registrable_domain", "source_type"
    )


@query(f"""WITH {_PAGES} SELECT run_id, count(*) FILTER (source_type = 'brand_official') AS official, count(*) AS citations,
  CAST(count(*) FILTER (source_type = 'brand_official') AS DOUBLE) / count(*) AS share FROM classified GROUP BY run_id""")
def official_share(spark, sf_dir):
    """A5."""
    return citations.official_share(_classified(spark, sf_dir)).drop("display")


@query(f"""WITH {_PAGES}, types(source_type) AS (VALUES {", ".join(f"('{t}')" for t in fixed.SOURCE_TYPES)}), n AS (SELECT run_id, source_type,
  count(*) AS n FROM firsts GROUP BY ALL), totals AS (SELECT run_id, sum(n) AS total FROM n GROUP BY run_id)
SELECT totals.run_id, types.source_type, coalesce(n.n, 0) AS n, CAST(coalesce(n.n, 0) AS DOUBLE) / total AS share FROM totals CROSS JOIN types
  LEFT JOIN n ON n.run_id = totals.run_id AND n.source_type = types.source_type""")
def source_types(spark, sf_dir):
    """W3, A6."""
    return citations.type_distribution(citations.first_of_page(_classified(spark, sf_dir)))


@query(f"""WITH {_PAGES} SELECT * FROM (SELECT run_id, registrable_domain AS key, count(DISTINCT answer_id) AS answers,
  row_number() OVER (PARTITION BY run_id ORDER BY count(DISTINCT answer_id) DESC, registrable_domain) AS place FROM firsts
  GROUP BY run_id, registrable_domain) WHERE place <= 8""")
def top_domains(spark, sf_dir):
    """A7, L1."""
    return _placed(citations.top_keys(citations.first_of_page(_classified(spark, sf_dir)), "domain"))


@query(f"""WITH {_PAGES} SELECT * FROM (SELECT run_id, canonical_url AS key, count(DISTINCT answer_id) AS answers, row_number() OVER (PARTITION BY run_id
  ORDER BY count(DISTINCT answer_id) DESC, canonical_url) AS place FROM firsts WHERE source_type = 'brand_official' GROUP BY run_id, canonical_url)
  WHERE place <= 8""")
def top_official_pages(spark, sf_dir):
    """A7, L1 for pages of the target."""
    return _placed(citations.top_official_pages(citations.first_of_page(_classified(spark, sf_dir))))


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("place", F.col("place").cast("long"))


@query(f"""WITH {_PAGES}, u AS (SELECT run_id, host, canonical_url, min((answer_id, citation_no)) AS seen FROM classified WHERE source_type = 'other'
  GROUP BY ALL),
k AS (SELECT run_id, host, canonical_url, row_number() OVER (PARTITION BY run_id, host ORDER BY seen, canonical_url) AS k FROM u),
h AS (SELECT run_id, host, count(*) AS citations FROM classified WHERE source_type = 'other' GROUP BY ALL)
SELECT h.run_id, h.host, h.citations, (SELECT string_agg(canonical_url, ' ' ORDER BY k.k) FROM k
  WHERE k.run_id = h.run_id AND k.host = h.host AND k.k <= 3) AS urls, 'S-' || lpad(CAST(row_number() OVER (PARTITION BY h.run_id
  ORDER BY h.host) AS VARCHAR), 3, '0') AS item_id FROM h""")
def unknown_hosts(spark, sf_dir):
    """S11, W5."""
    return citations.unknown_hosts(_classified(spark, sf_dir)).select(
        "run_id", "host", "citations", F.array_join("canonical_urls", " ").alias("urls"), "item_id"
    )


@query("""WITH s AS (SELECT 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, conv_id AS question_id, turn,
  CAST(conv_id AS VARCHAR) || '-r' || lpad(CAST(turn AS VARCHAR), 2, '0') AS sample_id, coalesce(role = 'assistant', false) AND coalesce(trim(text) <> '',
  false) AS eligible FROM conversations)
SELECT run_id, question_id, sample_id, eligible, count(*) FILTER (eligible) OVER w > 1 AS repeated FROM s WINDOW w AS (PARTITION BY run_id, question_id)
  QUALIFY row_number() OVER (PARTITION BY run_id, question_id ORDER BY eligible DESC, turn, sample_id) = 1""")
def representative_samples(spark, sf_dir):
    """W1."""
    return sampling.representative(tables.samples(spark, sf_dir)).select("run_id", "question_id", "sample_id", "eligible", "repeated")


@query("""WITH s AS (SELECT 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, CASE WHEN NOT coalesce(trim(text) <> '', false) THEN 'invalid'
  WHEN role = 'assistant' THEN 'success' ELSE 'failed' END AS status FROM conversations)
SELECT run_id, count(*) AS planned, count(*) AS completed, count(*) FILTER (status = 'success') AS valid, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'invalid') AS invalid, CAST(0 AS BIGINT) AS pending FROM s GROUP BY run_id""")
def crawl_counts(spark, sf_dir):
    """A10."""
    return sampling.crawl_counts(tables.samples(spark, sf_dir))


@query(f"""WITH {_ANSWERS} SELECT run_id, count(*) AS designed, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid_or_missing,
  count(*) FILTER (valid AND question_type = 'generic') AS valid_generic FROM answers GROUP BY run_id""")
def coverage(spark, sf_dir):
    """A9."""
    return sampling.coverage(tables.answers(spark, sf_dir))


@query(r"""SELECT conv_id, turn, CASE WHEN coalesce(trim(text, E' \t\n\r'), '') = '' THEN 'EMPTY_ANSWER'
  WHEN regexp_matches(text, '(?is)\b(log in|login|sign in|sign up)\b.{0,80}\b(chatgpt|account|continue)\b') THEN 'LOGIN_REQUIRED'
WHEN regexp_matches(text, '(?i)\b(something went wrong|internal server error|bad gateway|service unavailable|try again later)\b') THEN 'ERROR_PAGE' END AS code FROM conversations""")
def answer_validity(spark, sf_dir):
    """P2; the sample texts hold no refusals or placeholders, which tests cover."""
    return tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", ingest.validity(F.col("text")).alias("code"))


@query(f"WITH {_JUDGED} SELECT source AS run_id, answer_id, label, status FROM judged JOIN documents ON doc_id = answer_id")
def sentiment_routing(spark, sf_dir):
    """P11, P13."""
    return _judged(spark, sf_dir).select("run_id", "answer_id", sentiment.label_of(F.col("score")).alias("label"), "status")


@query(f"""WITH {_ANSWERS}, {_JUDGED}, j AS (SELECT a.run_id, label, status FROM answers a
  JOIN found f ON f.run_id = a.run_id AND f.answer_id = a.answer_id AND f.object_id = 'target' LEFT JOIN judged USING (answer_id) WHERE valid),
c AS (SELECT run_id, count(*) FILTER (status = 'accepted' AND label = 'positive') AS positive, count(*) FILTER (status = 'accepted'
  AND label = 'neutral') AS neutral, count(*) FILTER (status = 'accepted' AND label = 'negative') AS negative,
  count(*) FILTER (coalesce(status <> 'accepted', true)) AS unresolved FROM j GROUP BY run_id)
SELECT run_id, positive, neutral, negative, unresolved, CASE
  WHEN positive + negative > 0 THEN CAST(positive AS DOUBLE) / (positive + negative) END AS positive_ratio
  FROM c""".replace("USING (answer_id)", "ON judged.answer_id = a.answer_id"))
def target_sentiment(spark, sf_dir):
    """A4."""
    rows, _, found = _found(spark, sf_dir)
    return sentiment.target_sentiment(rows, found, _judged(spark, sf_dir)).select("run_id", "positive", "neutral", "negative", "unresolved", "positive_ratio")


@query(f"""WITH {_ANSWERS} SELECT a.run_id, a.answer_id, (row_number() OVER (PARTITION BY a.run_id ORDER BY a.answer_id) - 1) // 10 AS batch_no
  FROM answers a JOIN found f ON f.run_id = a.run_id AND f.answer_id = a.answer_id AND object_id = 'target' WHERE valid""")
def sentiment_work(spark, sf_dir):
    """S12, W8."""
    rows, _, found = _found(spark, sf_dir)
    return sentiment.work_list(rows, found)


_BUCKETS = f"""{_ANSWERS}, o AS (SELECT a.run_id, a.answer_id, a.funnel_intent, a.sequence, report_rank, CASE
  WHEN report_rank IS NULL THEN 'priority_improve' WHEN report_rank >= 4 THEN 'continue_optimize' ELSE 'stable' END AS bucket
  FROM answers a LEFT JOIN found f ON f.run_id = a.run_id AND f.answer_id = a.answer_id AND object_id = 'target' WHERE valid AND question_type = 'generic')"""


@query(f"""WITH {_BUCKETS} SELECT run_id, count(*) FILTER (bucket = 'priority_improve') AS priority_improve,
  count(*) FILTER (bucket = 'continue_optimize') AS continue_optimize, count(*) FILTER (bucket = 'stable') AS stable FROM o GROUP BY run_id""")
def opportunity_counts(spark, sf_dir):
    """P7, A8."""
    rows, _, found = _found(spark, sf_dir)
    return results.opportunity_counts(results.opportunities(rows, found))


@query(f"""WITH {_BUCKETS} SELECT * FROM (SELECT run_id, answer_id, bucket, row_number() OVER (PARTITION BY run_id, bucket ORDER BY CASE funnel_intent
  WHEN 'decision' THEN 0 WHEN 'comparison' THEN 1 ELSE 2 END,
CASE bucket WHEN 'continue_optimize' THEN -report_rank WHEN 'stable' THEN report_rank ELSE 0 END, sequence, answer_id) AS place FROM o) WHERE place <= 3""")
def opportunity_top(spark, sf_dir):
    """L2, W7."""
    rows, _, found = _found(spark, sf_dir)
    return _placed(results.opportunity_top(results.opportunities(rows, found))).select("run_id", "answer_id", "bucket", "place")


@query(f"""WITH {_ANSWERS}, {_METRICS}, v AS (SELECT run_id, object_id, display_order, metric, value, value * CASE metric WHEN 'average_rank' THEN -1
  ELSE 1 END AS s FROM (
  SELECT run_id, object_id, display_order, 'mention_rate' AS metric, CASE WHEN answers > 0 THEN CAST(mentions AS DOUBLE) / answers END AS value FROM metrics
    WHERE role = 'competitor'
  UNION ALL SELECT run_id, object_id, display_order, 'share_of_voice', CASE WHEN all_mentions > 0 THEN CAST(mentions AS DOUBLE) / all_mentions END
    FROM metrics WHERE role = 'competitor'
  UNION ALL SELECT run_id, object_id, display_order, 'average_rank', CASE WHEN mentions > 0 THEN CAST(rank_sum AS DOUBLE) / mentions END FROM metrics
    WHERE role = 'competitor') WHERE value IS NOT NULL),
b AS (SELECT * FROM v QUALIFY s = max(s) OVER (PARTITION BY run_id, metric))
SELECT run_id, metric, max(value) AS best_value, arg_min(object_id, display_order) AS selected_competitor, string_agg(object_id, ' '
  ORDER BY display_order) AS tied FROM b GROUP BY run_id, metric""")
def competitor_benchmarks(spark, sf_dir):
    """A11."""
    return results.benchmarks(_metrics(spark, sf_dir)).withColumn("tied", F.array_join("tied", " "))


_COLUMNS = {
    "answer_id": "doc_id", "answer_text": "text", "funnel_intent": "['decision', 'comparison', 'recommendation'][doc_id % 3 + 1]",
    "question_type": "CASE WHEN lang = 'en' THEN 'generic' ELSE 'branded' END", "run_id": "source", "sequence": "doc_id",
    "valid": r"coalesce(trim(text, ' ') <> '', false)"
}
_ENCODED = ", ".join(f"'{n}=', coalesce(strlen(CAST(({c}) AS VARCHAR)) || ':' || CAST(({c}) AS VARCHAR), '-')" for n, c in _COLUMNS.items())


@query(f"""WITH RECURSIVE h AS (SELECT source AS run_id, doc_id, sha256(concat({_ENCODED})) AS h FROM documents),
p AS (SELECT run_id, h, row_number() OVER (PARTITION BY run_id ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY run_id) AS n FROM h),
t(run_id, rows, place, h, n) AS (
  SELECT run_id, n, place // 32, sha256(string_agg(h, '' ORDER BY place)), (n + 31) // 32 FROM p GROUP BY run_id, n, place // 32
  UNION ALL
  SELECT run_id, rows, place // 32, sha256(string_agg(h, '' ORDER BY place)), (n + 31) // 32 FROM t WHERE n > 1 GROUP BY run_id, rows, place // 32, n)
SELECT run_id, rows, h AS fingerprint FROM t WHERE n = 1""")
def content_fingerprints(spark, sf_dir):
    """A29 over the answers of each run, in the order of their ids."""
    return results.fingerprints(tables.answers(spark, sf_dir), ["answer_id"], "run_id")


def _labelled(rows: DataFrame, **columns) -> DataFrame:
    """Flags of questions as the bank's rules read them: the given columns, the others null or false."""
    blank = {
        n: F.lit(None).cast("string") for n in ("question_id", "norm", "intent_key", "cluster", "scenario", "constraint", "audience_role", "opener")
    } | {n: F.lit(False) for n in ("current", "promotional", "low_confidence", "commercial")}
    return rows.select("bank_id", "row_no", *[c.alias(n) for n, c in (blank | columns).items()])


@query("""WITH p AS (SELECT p_brand AS bank_id, lower(p_type) AS k FROM part), n AS (SELECT bank_id, k, count(*) AS n FROM p GROUP BY ALL)
SELECT bank_id, CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (n = 1) AS single_cluster,
  CAST(count(*) FILTER (n = 1) AS DOUBLE) / sum(n) AS single_cluster_ratio FROM n GROUP BY bank_id""")
def label_singletons(spark, sf_dir):
    """A21 on parts: a brand is a bank, a type a label."""
    part = tables.read(spark, sf_dir, "part").select(F.col("p_brand").alias("bank_id"), F.col("p_partkey").alias("row_no"), "p_type")
    return bank.style(_labelled(part, cluster=text.normalize_name(F.col("p_type")))).select("bank_id", "total", "single_cluster", "single_cluster_ratio")


def _texts(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select(
        F.col("source").alias("bank_id"), F.col("doc_id").alias("row_no"), text.normalize_name(F.col("text")).alias("n")
    )
    return _labelled(docs.where("n != ''"), **columns)


@query(r"""WITH d AS (SELECT source AS bank_id, doc_id, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents),
o AS (SELECT bank_id, str_split(norm, ' ')[1] AS opener, count(*) AS n, min(doc_id) AS first FROM d WHERE norm <> '' GROUP BY ALL)
SELECT bank_id, CAST(sum(n) AS BIGINT) AS total, arg_max(opener, (n, -first)) AS opener, max(n) AS opener_n,
  coalesce(CAST(sum(n) FILTER (opener IN ('how', 'what', 'which')) AS BIGINT), 0) AS common FROM o GROUP BY bank_id""")
def dominant_openers(spark, sf_dir):
    """First words of whole texts as openers."""
    rows = bank.style(_texts(spark, sf_dir, opener=F.substring_index("n", " ", 1)))
    return rows.select(
        "bank_id", "total", F.col("top_opener").alias("opener"), F.col("top_opener_n").alias("opener_n"), F.col("common_openers").alias("common")
    )


@query(r"""WITH d AS (SELECT source AS bank_id, trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS norm FROM documents)
SELECT bank_id, md5(norm) AS key, count(*) AS n FROM d WHERE norm <> '' GROUP BY bank_id, norm HAVING count(*) > 1""")
def duplicate_questions(spark, sf_dir):
    """Normalised texts that occur more than once in a run."""
    return bank.duplicates(_texts(spark, sf_dir, norm=F.col("n"))).select("bank_id", F.md5("key").alias("key"), "n")


@query(r"""WITH q AS (SELECT p_brand AS bank_id, str_split(p_type, ' ')[1] AS k, count(*) AS actual FROM part
  GROUP BY ALL), e AS (SELECT DISTINCT p_brand AS bank_id, k.k, CAST(5 AS BIGINT) AS expected FROM part, (SELECT DISTINCT str_split(p_type, ' ')[1] AS k
  FROM part) k)
SELECT coalesce(q.bank_id, e.bank_id) AS bank_id, 'question_type' AS dimension, coalesce(q.k, e.k) AS key, coalesce(actual, 0) AS actual,
  coalesce(expected, 0) AS expected FROM q FULL JOIN e ON q.bank_id = e.bank_id AND q.k = e.k WHERE coalesce(actual, 0) <> coalesce(expected, 0)""")
def quota_differences(spark, sf_dir):
    """A17, J17 on parts: a brand is a bank, the first word of a type a question type, with a quota of five each."""
    part = tables.read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("bank_id"), F.substring_index("p_type", " ", 1).alias("question_type"), F.lit("all").alias("funnel_intent")
    )
    kinds = part.select("question_type").distinct()
    quotas = part.select("bank_id").distinct().withColumn("_", F.lit(1)).join(kinds.withColumn("_", F.lit(1)), "_").select(
        "bank_id", F.lit("question_type").alias("dimension"), F.col("question_type").alias("key"), F.lit(5).cast("long").alias("expected")
    )
    return bank.quota_differences(part, quotas).select("bank_id", "dimension", "key", "actual", "expected")


@query(r"""SELECT doc_id, regexp_matches(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) || ' ', ' the that ') AS has_name,
  regexp_matches(coalesce(text, ''), '(?i)(^|[^a-z0-9])the[\s_-]*that([^a-z0-9]|$)') AS has_entity FROM documents""")
def name_hits(spark, sf_dir):
    """A name of two tokens, written `TheThat` in the configuration."""
    docs = tables.read(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", text.contains_name(F.col("text"), F.lit("the that")).alias("has_name"),
        F.rlike(text.or_empty(F.col("text")), text.entity_pattern(F.lit("TheThat"))).alias("has_entity")
    )


def _bounded(pattern: str) -> str:
    """A pattern of alternatives between word boundaries, spelt with the characters around them for SQL."""
    parts = pattern.removeprefix("(?i)").split(r"\b")
    return "(?i)" + "".join(x + (("(^|[^\\p{L}\\p{N}_])", "([^\\p{L}\\p{N}_]|$)")[k % 2] if k < len(parts) - 1 else "") for k, x in enumerate(parts))


@query(rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'which platform review is best' WHEN doc_id % 3 = 1 THEN 'most even review'
  ELSE '' END || ' ' || coalesce(text, '') AS t FROM documents)
SELECT doc_id, regexp_matches(t, '{_bounded(fixed.PROMOTIONAL)}') AS promotional, regexp_matches(t, '{_bounded(fixed.LOW_CONFIDENCE)}')
  AND NOT regexp_matches(t, '{_bounded(fixed.PROMOTIONAL)}') AS low_confidence, regexp_matches(t, '[A-Za-z]') AS english FROM d""")
def wording_flags(spark, sf_dir):
    """P18, P29 over whole texts, two in three of which begin with words that may promote."""
    k = F.col("doc_id") % 3
    t = F.concat_ws(" ", F.when(k == 0, "which platform review is best").when(k == 1, "most even review").otherwise(""), text.or_empty(F.col("text")))
    return tables.read(spark, sf_dir, "documents").select("doc_id", *bank.wording(t), operators_imports.is_english(t).alias("english"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.read(spark, sf_dir, "events")
    return grounding.flatten(
        events.select(F.col("user_id").alias("run_id"), F.lit("props").alias("section"), F.try_parse_json("props").alias("body")).where("body is not null")
    )


@query("""SELECT user_id AS run_id, '/' || k AS pointer, count(*) AS n, sum(CAST(json_extract_string(props, '$.' || k) AS BIGINT))::BIGINT AS total
  FROM (SELECT user_id, props, unnest(json_keys(props)) AS k FROM events) GROUP BY ALL""")
def fact_leaves(spark, sf_dir):
    """leaves of JSON properties."""
    leaves = _facts(spark, sf_dir).where("kind = 'BIGINT'")
    return leaves.groupBy("run_id", "pointer").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


@query("""WITH v AS (SELECT user_id AS run_id, CAST(json_extract_string(props, '$.' || k) AS BIGINT) AS x
  FROM (SELECT user_id, props, unnest(json_keys(props)) AS k FROM events))
SELECT DISTINCT run_id, token FROM (SELECT run_id, CAST(x AS VARCHAR) AS token FROM v UNION ALL SELECT run_id, CAST(x * 100 AS VARCHAR) FROM v
  WHERE abs(x) <= 1 UNION ALL SELECT run_id, CAST(x * 100 AS VARCHAR) || '%' FROM v WHERE abs(x) <= 1)""")
def allowed_numbers(spark, sf_dir):
    """A30, F17."""
    return grounding.allowed_numbers(_facts(spark, sf_dir))


@query(r"""SELECT doc_id, u.u AS token FROM (SELECT doc_id,
  unnest(regexp_extract_all(' ' || coalesce(text, ''), '(?:^|[^A-Za-z0-9_])(-?\d+(?:\.\d+)?%?)', 1)) AS u FROM documents) u""")
def number_tokens(spark, sf_dir):
    """F17 over whole texts."""
    docs = tables.read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(text.number_tokens(text.or_empty(F.col("text")))).alias("token"))


@query(r"""SELECT page_id, regexp_replace(rtrim(lower(regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1)), '.'), '^www\.', '') AS host FROM pages""")
def hosts(spark, sf_dir):
    """F5."""
    return tables.read(spark, sf_dir, "pages").select("page_id", urls.normalize_host(F.col("url")).alias("host"))


@query(f"""WITH {_PAGES}, d AS (SELECT run_id, source_type, CASE WHEN ascii(host) % 2 = 0 THEN 'ugc' ELSE 'media_review' END AS judged, CASE
  WHEN length(host) % 2 = 0 THEN 0.9 ELSE 0.5 END AS c FROM classified)
SELECT run_id, CASE WHEN source_type <> 'other' THEN source_type WHEN c >= 0.8 THEN judged ELSE 'other' END AS source_type, count(*) AS n FROM d
  GROUP BY ALL""")
def decided_types(spark, sf_dir):
    """Judged types of unknown hosts, a rule of the host's name standing for the judge."""
    cited = _classified(spark, sf_dir)
    work = citations.unknown_hosts(cited)
    judged = work.select(
        "run_id", "item_id", F.when(F.ascii("host") % 2 == 0, "ugc").otherwise("media_review").alias("source_type"),
        F.when(F.length("host") % 2 == 0, 0.9).otherwise(0.5).alias("confidence")
    )
    return citations.apply_decisions(cited, work, judged).groupBy("run_id", "source_type").agg(F.count("*").alias("n"))
