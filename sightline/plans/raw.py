"""Queries over raw JSON: crawls, question banks and configurations that Spark writes from rows of the tables.

A row makes a document of its own, so nothing is collected; the operators read the documents as they would read imported ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bank, bank_findings
from ..sources import ingest, tables
from .register import ORACLE, query

_TURNS = """turns AS (SELECT *, 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, CAST(conv_id AS VARCHAR) AS q, CAST(conv_id AS VARCHAR) || '-r' || CASE
  WHEN turn < 10 THEN '0' ELSE '' END || CAST(turn AS VARCHAR) AS sample_id, coalesce(role, '') AS r FROM conversations),
asked AS (SELECT DISTINCT run_id, q FROM turns WHERE conv_id % 10 <> 9),
invalid AS (SELECT *, CASE WHEN coalesce(trim(text, E' \\t\\n\\r'), '') = '' THEN 'EMPTY_ANSWER'
  WHEN regexp_matches(text, '(?is)\\b(log in|login|sign in|sign up)\\b.{0,80}\\b(chatgpt|account|continue)\\b') THEN 'LOGIN_REQUIRED'
  WHEN regexp_matches(text, '(?i)\\b(something went wrong|internal server error|bad gateway|service unavailable|try again later)\\b') THEN 'ERROR_PAGE' END AS bad FROM turns)"""


def _turns_sql() -> str:
    return _TURNS


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tables.read(spark, sf_dir, "conversations")
    return turns.select(
        "*", F.concat(F.lit("run"), (F.col("conv_id") % 7).cast("string")).alias("run_id"), F.col("conv_id").cast("string").alias("q"),
        F.format_string("%d-r%02d", "conv_id", "turn").alias("sample_id"), F.coalesce("role", F.lit("")).alias("r")
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A sample for each turn, odd ones with a plan and without a question id; questions of nine conversations in ten, and silent ones."""
    turns = _turns(spark, sf_dir)
    odd = F.col("turn") % 2 == 1
    result = F.when(F.col("r") == "assistant", F.struct(F.lit(True).alias("ok"), F.struct(F.coalesce("text", F.lit("")).alias("text")).alias("answer")))
    sample = F.struct(
        "sample_id", F.when(~odd, F.col("q")).alias("question_id"), F.when(F.col("turn") % 4 == 0, F.col("conv_id") % 3).alias("question_index"), F.col("turn").alias("repeat_index"), F.lit("success").alias("status"),
        (F.col("r") != "system").alias("ok"), result.alias("result")
    )
    plan = F.when(
        odd,
        F.array(
            F.struct(
                F.format_string("%d-r%02d", F.col("conv_id"), F.col("turn") + 1).alias("sample_id"), F.col("q").alias("question_id"),
                (F.col("turn") + 1).alias("repeat_index")
            )
        )
    )
    samples = turns.select("run_id", "conv_id", sample.alias("sample"), plan.alias("plan"))
    sequence = (F.col("conv_id") % 5).alias("sequence")
    known = turns.where("conv_id % 10 != 9").select(
        "run_id", F.col("q").alias("question_id"), F.concat(F.lit("Question "), "q").alias("question_text"), sequence
    ).distinct()
    silent = turns.where("conv_id % 10 = 8").select("run_id", F.concat(F.lit("s"), "q").alias("question_id"), F.lit("").alias("question_text"), sequence).distinct()
    return samples, known.unionByName(silent)


def _crawls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A batch document for each turn, and the questions."""
    samples, asked = _samples(spark, sf_dir)
    return samples.select("run_id", _json(samples=F.array("sample"), plan=F.col("plan")).alias("body")), asked


@query(f"""WITH {_TURNS}, late AS (SELECT run_id, q, conv_id, turn + 1 AS turn, q || '-r' || CASE WHEN turn + 1 < 10 THEN '0'
  ELSE '' END || CAST(turn + 1 AS VARCHAR) AS sample_id FROM turns WHERE turn % 2 = 1)
SELECT i.run_id, i.sample_id, a.q AS question_match, coalesce(code, 'OK') AS code
  FROM (SELECT *, CASE WHEN r = 'system' THEN 'SOURCE_FAILED' WHEN r <> 'assistant' THEN 'MISSING_RESULT' ELSE bad END AS code FROM invalid) i
  LEFT JOIN asked a ON a.run_id = i.run_id AND a.q = i.q
UNION ALL SELECT run_id, sample_id, q, 'PENDING' FROM late WHERE NOT EXISTS (SELECT 1 FROM turns t
  WHERE t.run_id = late.run_id AND t.sample_id = late.sample_id)
UNION ALL SELECT DISTINCT run_id, 's' || q || '-r01', 's' || q, 'PENDING' FROM turns WHERE conv_id % 10 = 8""")
def crawl_samples(spark, sf_dir):
    """S1, S3, P1, J1, J3, J4, U1."""
    raw, questions = _crawls(spark, sf_dir)
    return ingest.import_crawl(raw, questions).select("run_id", "sample_id", "question_match", F.coalesce("error_code", F.lit("OK")).alias("code"))


@query(f"""WITH {_TURNS} SELECT run_id, 'UNKNOWN_QUESTION' AS code, sample_id FROM turns WHERE conv_id % 10 = 9 UNION ALL
  SELECT run_id, 'DUPLICATE_SAMPLE', sample_id FROM turns GROUP BY run_id, sample_id HAVING count(*) > 1""")
def crawl_issues(spark, sf_dir):
    """J1, A14, U3."""
    return ingest.crawl_findings(ingest.import_crawl(*_crawls(spark, sf_dir)))


@query(f"""WITH {_TURNS} SELECT i.run_id, i.sample_id, ['results', 'list', 'object'][turn % 3 + 1] AS source_shape, a.q AS question_match, coalesce(CASE
  WHEN r = 'system' THEN 'SOURCE_FAILED' ELSE bad END, 'OK') AS code
FROM invalid i LEFT JOIN asked a ON a.run_id = i.run_id AND a.q = i.q""")
def collection_samples(spark, sf_dir):
    """Three shapes of raw results, matched to questions by their texts alone."""
    turns = _turns(spark, sf_dir)
    inner = F.struct("sample_id", F.concat(F.lit("  QUESTION\t"), "q").alias("question"))
    item = F.struct(inner.alias("manifest"), (F.col("r") != "system").alias("ok"), F.struct(F.coalesce("text", F.lit("")).alias("text")).alias("answer"))
    shape = F.col("turn") % 3
    raw = turns.select(
        "run_id", F.when(shape == 0, _json(results=F.array(item))).when(shape == 1, F.to_json(F.array(item))).otherwise(F.to_json(item)).alias("body")
    )
    asked = turns.where("conv_id % 10 != 9").select(
        "run_id", F.col("q").alias("question_id"), F.concat(F.lit("Question "), "q").alias("question_text")
    ).distinct()
    found = ingest.import_crawl(raw, asked).where("status != 'pending'")
    return found.select("run_id", "sample_id", "source_shape", "question_match", F.coalesce("error_code", F.lit("OK")).alias("code"))


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample for each page: its reference list names the url under one of three keys, is none or absent; its answer holds three links, one twice."""
    pages = tables.read(spark, sf_dir, "pages").withColumn("u", F.coalesce("url", F.lit("")))
    k = F.col("page_id") % 5
    named = lambda key: F.to_json(F.struct(F.col("u").alias(key)))
    block = (
        F.when(k == 0, F.concat(F.lit('{"count": 1, "items": ['), named("url"), F.lit("]}"))).when(k == 1, F.concat(F.lit('{"items": ['), named("link"), F.lit("]}")))
        .when(k == 2, F.lit('{"count": 1, "items": "none"}')).when(k == 3, F.concat(F.lit('{"count": 2, "items": ["x", '), named("href"), F.lit("]}")))
        .otherwise(F.lit('{"count": 1}'))
    )
    own = F.concat(F.lit("http://b.example/"), F.col("page_id").cast("string"))
    return pages.select(
        F.lit("r").alias("run_id"), F.col("page_id").cast("string").alias("sample_id"), F.lit(True).alias("analysis_eligible"),
        F.concat(F.lit("see "), own, F.lit("; "), "u", F.lit(" and "), own, F.lit(".")).alias("answer_text"), F.try_parse_json(block).alias("references")
    )


@query(r"""WITH p AS (SELECT page_id, page_id % 5 AS k, coalesce(url, '') AS u, CASE WHEN page_id % 5 IN (0, 1, 3) THEN 1 ELSE 0 END AS kept,
  'http://b.example/' || CAST(page_id AS VARCHAR) AS own FROM pages),
f AS (SELECT *, regexp_extract_all('see ' || own || '; ' || u || ' and ' || own || '.', '(?i)https?://[^\s)\]>"'']+') AS found FROM p),
b AS (SELECT page_id, k, u, kept, regexp_replace(unnest(found), '[.,;:]+$', '') AS x, generate_subscripts(found, 1) AS pos FROM f),
c AS (SELECT page_id, 'platform' AS citation_source, CASE k WHEN 3 THEN 2 ELSE 1 END AS source_order, nullif(trim(u), '') AS raw_url, 1 AS no FROM p
  WHERE kept = 1
UNION ALL SELECT page_id, 'body_link', kept + n, x, kept + n FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM b
  WHERE kept = 0 OR x <> trim(u)))
SELECT CAST(page_id AS VARCHAR) AS sample_id, citation_source, CAST(source_order AS BIGINT) AS source_order, raw_url,
  'C-' || CAST(page_id AS VARCHAR) || '-' || lpad(CAST(no AS VARCHAR), 3, '0') AS citation_id FROM c""")
def imported_citations(spark, sf_dir):
    """S7, S8, J8, U2, W4."""
    return ingest.citations(_cited(spark, sf_dir)).select(
        "sample_id", "citation_source", F.col("source_order").cast("long").alias("source_order"), "raw_url", "citation_id"
    )


@query("""SELECT c.code, CAST(page_id AS VARCHAR) AS sample_id FROM pages, (VALUES (2, 'INVALID_REFERENCE_ITEMS'), (2, 'REFERENCE_COUNT_MISMATCH'),
  (3, 'INVALID_REFERENCE_ITEM'), (4, 'REFERENCE_COUNT_MISMATCH')) c(k, code) WHERE page_id % 5 = c.k""")
def reference_issues(spark, sf_dir):
    """S7."""
    return ingest.reference_findings(_cited(spark, sf_dir)).select("code", "sample_id")


def _configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration for each supplier: up to four competitors, the first sharing an alias of the brand."""
    s = tables.read(spark, sf_dir, "supplier")
    nation = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    brand = F.struct(
        F.col("s_name").alias("name"), F.array(F.lower("s_name"), nation).alias("aliases"),
        F.concat(F.lit("HTTPS://WWW.S"), F.col("s_suppkey").cast("string"), F.lit(".Example.com:443/x")).alias("domain")
    )
    rival = F.transform(
        F.sequence(F.lit(1), F.lit(4)),
        lambda k: F.struct(F.concat(F.lit("Rival-"), k.cast("string")).alias("name"), F.when(k == 1, F.array(F.lower(nation))).alias("aliases"))
    )
    return s.select(
        F.col("s_suppkey").cast("string").alias("run_id"),
        _json(brand=brand, competitors=F.slice(rival, F.lit(1), (F.col("s_suppkey") % 5).cast("int"))).alias("body")
    )


_ALIASES = """aliases AS (SELECT CAST(s_suppkey AS VARCHAR) AS run_id, 'target' AS object_id, replace(lower(s_name), '#', ' ') AS alias_norm FROM supplier
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'target', 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'competitor-0' || CAST(k AS VARCHAR), 'rival ' || CAST(k AS VARCHAR) FROM supplier, range(1, 5) t(k)
  WHERE k <= s_suppkey % 5
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'competitor-01', 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 5 > 0)"""


@query(f"WITH {_ALIASES} SELECT * FROM aliases")
def object_aliases(spark, sf_dir):
    """S5, U6, F2."""
    return ingest.import_objects(_configs(spark, sf_dir))[1].select("run_id", "object_id", "alias_norm")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS run_id, 'target' AS object_id, 's' || CAST(s_suppkey AS VARCHAR) || '.example.com' AS domain FROM supplier")
def object_domains(spark, sf_dir):
    """S5, F5."""
    return ingest.import_objects(_configs(spark, sf_dir))[2].select("run_id", "object_id", "domain")


@query(f"""WITH {_ALIASES} SELECT run_id, alias_norm, count(DISTINCT object_id) AS owners FROM aliases
  GROUP BY run_id, alias_norm HAVING count(DISTINCT object_id) > 1""")
def alias_conflicts(spark, sf_dir):
    """J18."""
    return bank.alias_conflicts(ingest.import_objects(_configs(spark, sf_dir))[1])


def _bank(spark: SparkSession, sf_dir: str) -> bank.Bank:
    return bank.load(_bank_documents(spark, sf_dir))


def _bank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bank of four questions for each part: what is wrong with them follows from its size and type."""
    p = tables.spread(tables.read(spark, sf_dir, "part"), "p_partkey").withColumn("brand", F.replace("p_brand", F.lit("#"), F.lit(" ")))
    size = F.col("p_size")
    say = lambda *parts: F.concat(*[F.lit(x) if not isinstance(x, Column) else x for x in parts])
    name, brand, kind = F.col("p_name"), F.col("brand"), F.col("p_type")
    texts = (
        F.when(size % 7 == 0, say("Buy a ", name, "?")).otherwise(say("Which ", name, " fits us, ", kind, "?")),
        F.when(size % 3 == 0, say("Compare ", name, " and ", brand)).otherwise(say("Compare ", name, " makers")),
        F.when(size % 5 == 0, say("Compare the makers")).otherwise(say("Compare ", brand, " ", name)), say(
            "Evaluate the ", name, " product ", brand, " on ", F.when(size % 11 == 0, F.lower("p_name")).otherwise(kind)
        ),
    )
    flags = lambda k: F.create_map(
        *[x for n in (*bank.fixed.QUALITY_FLAGS, *bank.fixed.CURRENT_FLAGS) for x in (F.lit(n), (F.lit(n) != "answerable") | (size % 13 != k))]
    )
    questions = []
    for k, (text, type_, intent) in enumerate(
        zip(texts, ("generic", "generic", "branded", "branded"), ("recommendation", "comparison", "comparison", "decision"))
    ):
        fields = {n: F.lit("x") for n in (*bank.fixed.REQUIRED_FIELDS, *bank.fixed.CURRENT_FIELDS)} | {
            "question_id": F.lit(f"q{k}"), "question_type": F.lit(type_), "funnel_intent": F.lit(intent), "decision_stage": F.lit("purchase"),
            "audience_role": F.when(size % 2 == k % 2, "Buyers").otherwise("teams"), "user_question": text,
            "zh_translation": F.when(size % 6 == k, "no").otherwise("问题"),
            "monitoring_prompt": text, "topic_id": F.when(size % 9 == k, "t2").otherwise("T1"), "intent_key": F.lit(f"i{min(k, 2)}"),
            "quality_checks": flags(k), "title_seed": F.when(size % 4 == k, text).otherwise("seed"), "cluster": F.when(size % 2 == 0, f"c{k}").otherwise("c"),
        }
        if k == 1:
            fields["evidence_need"] = F.when(size % 10 != 1, "x")
        questions.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    config = F.struct(
        brand.alias("brand_name"), name.alias("category_label"), F.lit("product").alias("brand_object_type"), F.array(
            F.struct(F.lit("t1").alias("topic_id"), kind.alias("topic"))
        ).alias("topics"), F.when(size % 2 == 0, 4).otherwise(5).alias("expected_total"),
        F.array(F.lit("buyers"), F.lit("Nobody")).alias("target_audiences"), F.struct(
            F.struct(F.lit(2).alias("generic"), F.lit(1).alias("branded")).alias("question_type")
        ).alias("quotas"),
        F.struct(
            F.array(name).alias("core_terms"), F.array().cast("array<string>").alias("product_terms"), F.array(F.lit("anvil")).alias("placeholder_blacklist")
        ).alias("category_expression_set"), F.array(F.lit("ring")).alias("excluded_categories"),
        F.create_map(kind, F.struct(F.array(kind).alias("terms"), F.lit(2).alias("min_total"), F.lit(1).alias("min_generic"))).alias("required_term_coverage"),
    )
    return p.select(
        F.col("p_partkey").cast("string").alias("bank_id"),
        _json(schema_version=F.lit("overseas-geo-question-bank/v3"), config=config, questions=F.array(*questions)).alias("body")
    )


_PARTS = """parts AS (SELECT CAST(p_partkey AS VARCHAR) AS bank_id, p_size AS s, p_name AS n, p_type AS t, replace(p_brand, '#', ' ') AS b FROM part),
every AS (SELECT *, 'q' || CAST(k AS VARCHAR) AS question_id, CASE WHEN k < 2 THEN 'generic' ELSE 'branded' END AS question_type,
  CASE k WHEN 0 THEN CASE WHEN s % 7 = 0 THEN 'Buy a ' || n || '?' ELSE 'Which ' || n || ' fits us, ' || t || '?' END WHEN 1 THEN CASE
    WHEN s % 3 = 0 THEN 'Compare ' || n || ' and ' || b ELSE 'Compare ' || n || ' makers' END
  WHEN 2 THEN CASE WHEN s % 5 = 0 THEN 'Compare the makers' ELSE 'Compare ' || b || ' ' || n END
    ELSE 'Evaluate the ' || n || ' product ' || b || ' on ' || CASE WHEN s % 11 = 0 THEN n ELSE t END END AS text FROM parts, range(0, 4) r(k)),
q AS (SELECT * FROM every WHERE NOT (k = 1 AND s % 10 = 1))"""


@query(f"""WITH {_PARTS}, f(bank_id, question_id, code, hit) AS (
SELECT bank_id, question_id, 'MISSING_FIELDS', k = 1 AND s % 10 = 1 FROM every UNION ALL SELECT bank_id, question_id, 'BAD_TRANSLATION', s % 6 = k FROM q
  UNION ALL SELECT bank_id, question_id, 'BARE_ACTION', text LIKE 'Buy %' FROM q UNION ALL SELECT bank_id, question_id, 'NOT_NATURAL', text LIKE 'Buy %' FROM q
UNION ALL SELECT bank_id, question_id, 'REPEATS_FIELD', s % 4 = k FROM q UNION ALL SELECT bank_id, question_id, 'QUALITY_CHECKS', s % 13 = k FROM q
  UNION ALL SELECT bank_id, question_id, 'UNKNOWN_TOPIC', s % 9 = k FROM q
UNION ALL SELECT bank_id, question_id, 'SENTIMENT_TEMPLATE', k = 3 AND (s % 11 = 0 OR s % 9 = 3) FROM q UNION ALL
  SELECT bank_id, question_id, 'ENTITY_LEAK', k = 1 AND s % 3 = 0 FROM q UNION ALL SELECT bank_id, question_id, 'BRAND_MISSING', k = 2 AND s % 5 = 0 FROM q
UNION ALL SELECT bank_id, question_id, 'PLACEHOLDER', text LIKE '% anvil%' FROM q UNION ALL
  SELECT bank_id, question_id, 'CATEGORY_DRIFT', text LIKE '% ring%' FROM q UNION ALL
  SELECT bank_id, question_id, 'CATEGORY_HIDDEN', text NOT LIKE '%' || n || '%' FROM q)
SELECT bank_id, question_id, code FROM f WHERE hit""")
def bank_row_issues(spark, sf_dir):
    """S13, P15-P24, J16, J19, F8, F9, U5."""
    return bank_findings.row_findings(_bank_documents(spark, sf_dir)).select("bank_id", "question_id", "code")


@query(f"""WITH {_PARTS} SELECT bank_id, t AS concept, m.measure, CASE m.measure WHEN 'total' THEN hits WHEN 'generic' THEN generic
  WHEN 'branded' THEN hits - generic ELSE 0 END AS actual, CASE m.measure WHEN 'total' THEN 2 WHEN 'generic' THEN 1 ELSE 0 END AS minimum
  FROM (SELECT bank_id, any_value(t) AS t, count(*) FILTER (lower(text) LIKE '%' || lower(t) || '%') AS hits,
  count(*) FILTER (lower(text) LIKE '%' || lower(t) || '%' AND k < 2) AS generic FROM q
  GROUP BY bank_id), (VALUES ('total'), ('generic'), ('branded'), ('expanded'), ('acronym')) m(measure)""")
def bank_terms(spark, sf_dir):
    """A18."""
    b = _bank(spark, sf_dir)
    return bank.term_coverage(b, bank.row_flags(b))


@query(f"""WITH {_PARTS} SELECT bank_id, 'question_type' AS dimension, question_type AS key, count(*) AS actual, CASE question_type WHEN 'generic' THEN 2
  ELSE 1 END AS expected FROM q GROUP BY bank_id, question_type HAVING count(*) <> CASE question_type WHEN 'generic' THEN 2 ELSE 1 END""")
def bank_quotas(spark, sf_dir):
    """A17, J17."""
    b = _bank(spark, sf_dir)
    return bank.quota_differences(bank.row_flags(b), b.quotas).select("bank_id", "dimension", "key", "actual", "expected")


@query(f"WITH {_PARTS} SELECT bank_id, 'intent_key' AS what, 'i2' AS key, CAST(2 AS BIGINT) AS n FROM parts")
def bank_duplicates(spark, sf_dir):
    """A14, A15."""
    return bank.duplicates(bank.row_flags(_bank(spark, sf_dir)))


@query(f"WITH {_PARTS} SELECT bank_id, 't1' AS topic_id, CAST(0 AS BIGINT) AS n FROM parts WHERE s % 9 = 3")
def bank_topics(spark, sf_dir):
    """A16."""
    b = _bank(spark, sf_dir)
    return bank.topic_coverage(b, bank.row_flags(b)).select("bank_id", "topic_id", "n")


@query(f"""WITH {_PARTS}, g AS (SELECT bank_id, count(*) AS every, count(*) FILTER (s % 2 = k % 2) AS own, count(*) FILTER (s % 2 = k % 2
  AND k = 0) AS recommendation, count(*) FILTER (s % 2 = k % 2 AND k = 1) AS comparison FROM q WHERE k < 2 GROUP BY bank_id)
SELECT bank_id, 'buyers' AS audience, own AS generic_total, recommendation, comparison, CAST(0 AS BIGINT) AS decision, CAST(own AS DOUBLE) / every AS share
  FROM g UNION ALL SELECT bank_id, 'Nobody', 0, 0, 0, 0, CAST(0 AS DOUBLE) FROM g""")
def bank_audiences(spark, sf_dir):
    """A24."""
    b = _bank(spark, sf_dir)
    return bank.audience_coverage(b, bank.row_flags(b))


@query(f"""WITH {_PARTS}, o AS (SELECT bank_id, regexp_extract(lower(text), '^[a-z]+') AS opener, count(*) AS n, min(k) AS first FROM q GROUP BY ALL)
SELECT c.bank_id, total, single_cluster, common_openers, top_opener, CAST(4 AS BIGINT) AS commercial
  FROM (SELECT bank_id, count(*) AS total, CASE WHEN any_value(s) % 2 = 0 THEN count(*) ELSE 0 END AS single_cluster FROM q GROUP BY bank_id) c
JOIN (SELECT bank_id, coalesce(sum(n) FILTER (opener IN ('how', 'what', 'which')), 0)::BIGINT AS common_openers, arg_max(opener, (n, -first)) AS top_opener
  FROM o GROUP BY bank_id) p ON p.bank_id = c.bank_id""")
def bank_style(spark, sf_dir):
    """A bank's four questions are all reviewed as commercial, the incomplete one too."""
    b = _bank(spark, sf_dir)
    flags = bank.row_flags(b)
    rows = bank.style(flags).join(bank.review_counts(b, flags), "bank_id")
    return rows.select("bank_id", "total", "single_cluster", "common_openers", "top_opener", "commercial")


@query(f"""SELECT bank_id, code, question_id FROM ({ORACLE["bank_row_issues"]})
UNION ALL SELECT bank_id, 'QUOTA', NULL FROM ({ORACLE["bank_quotas"]})
UNION ALL SELECT bank_id, 'DUPLICATE', NULL FROM ({ORACLE["bank_duplicates"]})
UNION ALL SELECT bank_id, 'TOPIC_SENTIMENT', NULL FROM ({ORACLE["bank_topics"]})
UNION ALL SELECT bank_id, 'TERM_COVERAGE', NULL FROM ({ORACLE["bank_terms"]}) WHERE actual < minimum
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'COUNT', NULL FROM part WHERE p_size % 2 = 1
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'ASSESSMENT_SHAPE', NULL FROM part""")
def bank_findings_of_all_rules(spark, sf_dir):
    """Every finding of a bank, of its configuration, rows and batch, in one pass."""
    return bank_findings.all_findings(_bank_documents(spark, sf_dir)).select("bank_id", "code", "question_id")
