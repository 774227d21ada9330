"""Queries over imports: question banks and run configurations that Spark writes from suppliers and parts, with faults of every kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import imports, mentions
from ..sources import ingest, tables
from .raw import _crawls, _json, _turns_sql
from .register import query


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tables.read(spark, sf_dir, "supplier")
    return s.select(
        "*", F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("run_id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nation")
    )


@query("""SELECT p_brand AS run_id, CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'q01' END AS question_id, CASE
  WHEN p_size % 3 = 0 THEN p_size ELSE 1 END AS sequence, p_name AS question_text,
CASE p_size % 4 WHEN 0 THEN 'generic' WHEN 1 THEN 'generic' WHEN 2 THEN 'branded' END AS question_type,
CASE p_size % 5 WHEN 0 THEN 'recommendation' WHEN 1 THEN 'recommendation' WHEN 2 THEN 'comparison' WHEN 3 THEN 'decision' END AS funnel_intent,
  p_size % 5 = 1 AS migrated FROM part""")
def imported_questions(spark, sf_dir):
    """Parts as questions, with field names and labels in several spellings; a missing id follows from the place."""
    part = tables.read(spark, sf_dir, "part")
    size = F.col("p_size")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), size % n + 1)
    q = F.struct(
        F.when(size % 2 == 0, F.col("p_partkey").cast("string")).alias("id"),
        F.when(size % 3 == 0, size).alias("generation_sequence"),
        F.when(size % 2 == 0, F.concat(F.lit(" "), "p_name")).alias("monitoring_prompt"),
        F.when(size % 2 == 1, F.col("p_name")).alias("standalone_rewrite"),
        pick(4, "generic", "category", "brand_related", "Generic").alias("type"),
        pick(5, "recommendation", "awareness", "commercial", "决策", "none").alias("purchase_intent"),
    )
    found = ingest.import_questions(part.select(F.col("p_brand").alias("run_id"), _json(questions=F.array(q)).alias("body")))
    return found.select("run_id", "question_id", "sequence", "question_text", "question_type", "funnel_intent", "migrated")


def _banks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """For each supplier a bank of four questions, now and then with a fifth that is no object, and its configuration."""
    s, k = _suppliers(spark, sf_dir), F.col("k")
    texts = (
        F.when((k % 7 == 0) & (k % 5 > 0), "Which tool beats Rival-1?").otherwise("Which tool fits us?"),
        F.when(k % 13 == 0, "  ").otherwise("Compare tools"),
        F.when(k % 4 == 0, F.lit("Is it good?")).otherwise(F.concat(F.lit("Is "), "s_name", F.lit(" good?"))),
        F.when(k % 9 == 0, "问题").otherwise("Where to buy tools"),
    )
    one = _json(question_type=F.lit("generic"), funnel_intent=F.lit("推荐"), monitoring_prompt=texts[0])
    two = _json(
        id=F.when(k % 11 == 0, "Q01").otherwise("b"), type=F.lit("category"), intent=F.when(k % 3 == 0, "awareness").otherwise("commercial"),
        user_question=texts[1], question_zh=F.lit("问题")
    )
    three = _json(question_id=F.lit("c"), type=F.lit("brand"), purchase_intent=F.lit("决策"), question=texts[2], index=F.lit(1))
    four = _json(
        question_id=F.lit("D"), question_type=F.when(k % 6 == 0, "Generic").otherwise("generic"), intent=F.when(k % 8 == 0, "buy").otherwise("decision"),
        question_text=texts[3], generation_sequence=F.lit(1)
    )
    odd = F.when(k % 10 == 0, ', "x"').otherwise("")
    banks = s.select("run_id", F.concat(F.lit('{"questions": ['), F.concat_ws(", ", one, two, three, four), odd, F.lit("]}")).alias("body"))
    quotas = F.struct(F.struct(F.lit(3).alias("generic"), F.when(k % 2 == 0, 1).otherwise(2).alias("brand")).alias("question_type"))
    brand = F.struct(F.col("s_name").alias("name"), F.array(F.lower("s_name"), F.col("nation")).alias("aliases"), F.lit("a.example").alias("domain"))
    rivals = F.when(k % 5 > 0, F.array(F.struct(F.lit("Rival-1").alias("name"), F.lit("b.example").alias("domain"))))
    return banks, s.select("run_id", _json(topic=F.lit("tools"), brand=brand, competitors=rivals, quotas=quotas).alias("body"))


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS run_id FROM supplier),
f(run_id, code, question_id, detail, severity, hit) AS (
SELECT run_id, 'NOT_AN_OBJECT', 'q05', NULL, 'error', k % 10 = 0 FROM s UNION ALL
  SELECT run_id, 'NO_TEXT', CASE WHEN k % 11 = 0 THEN 'Q01' ELSE 'b' END, NULL, 'error', k % 13 = 0 FROM s
UNION ALL SELECT run_id, 'BAD_TYPE', 'D', NULL, 'error', k % 6 = 0 FROM s UNION ALL SELECT run_id, 'BAD_INTENT', 'D', NULL, 'error', k % 8 = 0 FROM s
  UNION ALL SELECT run_id, 'NOT_ENGLISH', 'D', NULL, 'error', k % 9 = 0 FROM s
UNION ALL SELECT run_id, 'NO_TRANSLATION', q, NULL, 'warning', true FROM s, (VALUES ('q01'), ('c'), ('D')) v(q) UNION ALL
  SELECT run_id, 'LEGACY_LABEL', CASE WHEN k % 11 = 0 THEN 'Q01' ELSE 'b' END, NULL, 'warning', k % 3 = 0 FROM s
UNION ALL SELECT run_id, 'GENERIC_NAMES_OBJECT', 'q01', 'competitor-01', 'error', k % 7 = 0 AND k % 5 > 0 FROM s UNION ALL
  SELECT run_id, 'BRANDED_WITHOUT_TARGET', 'c', NULL, 'error', k % 4 = 0 FROM s
UNION ALL SELECT run_id, 'DUPLICATE_ID', 'q01', '2', 'error', k % 11 = 0 FROM s UNION ALL SELECT run_id, 'TOTAL', NULL, '4/5', 'error', k % 2 = 1 FROM s
UNION ALL SELECT run_id, 'TYPE_QUOTA', NULL, CASE WHEN k % 6 = 0 THEN '2' ELSE '3' END || ',1/3,' || CASE WHEN k % 2 = 0 THEN '1' ELSE '2' END, 'error',
  k % 2 = 1 OR k % 6 = 0 FROM s
UNION ALL SELECT run_id, 'NO_INTENT', NULL, 'comparison', 'error', k % 3 = 0 FROM s)
SELECT run_id, code, question_id, detail, severity FROM f WHERE hit""")
def question_import_issues(spark, sf_dir):
    """Every finding of imported banks."""
    banks, configs = _banks(spark, sf_dir)
    objects, aliases, _ = ingest.import_objects(configs)
    patterns = mentions.alias_patterns(aliases).join(objects.select("run_id", "object_id", "role"), ["run_id", "object_id"])
    return imports.question_findings(ingest.import_questions(banks), patterns, ingest.import_runs(configs))


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS run_id FROM supplier),
q AS (SELECT run_id, q.id, q.seq, q.place FROM s, (VALUES ('q01', 1, 1), ('b', 2, 2), ('c', 1, 3), ('D', 1, 4), ('q05', 5, 5)) q(id, seq, place)
  WHERE place < 5 OR k % 10 = 0),
n AS (SELECT q.run_id, CASE WHEN place = 2 AND CAST(q.run_id AS BIGINT) % 11 = 0 THEN 'Q01' ELSE id END AS question_id, seq, place FROM q)
SELECT run_id, question_id, row_number() OVER (PARTITION BY run_id ORDER BY seq, lower(question_id), place) AS order_no FROM n""")
def question_order(spark, sf_dir):
    """L4: questions by sequence and case-folded id."""
    return imports.ordered_questions(ingest.import_questions(_banks(spark, sf_dir)[0])).select(
        "run_id", "question_id", F.col("order_no").cast("long").alias("order_no")
    )


@query(f"""WITH {_turns_sql()}, late AS (SELECT run_id, q, conv_id, turn + 1 AS turn, q || '-r' || CASE WHEN turn + 1 < 10 THEN '0'
  ELSE '' END || CAST(turn + 1 AS VARCHAR) AS sample_id FROM turns WHERE turn % 2 = 1),
asked_in AS (SELECT conv_id, CASE WHEN conv_id % 10 <> 9 THEN conv_id % 5 END AS sequence FROM (SELECT DISTINCT conv_id FROM turns)),
every AS (SELECT run_id, sample_id, greatest(turn, 1) AS r, coalesce(nullif(CASE WHEN turn % 4 = 0 THEN t.conv_id % 3 END, 0), sequence, 0) AS i FROM turns t
  JOIN asked_in a ON a.conv_id = t.conv_id
UNION ALL SELECT run_id, sample_id, turn, coalesce(sequence, 0) FROM late JOIN asked_in a ON a.conv_id = late.conv_id WHERE NOT EXISTS (SELECT 1
  FROM turns t WHERE t.run_id = late.run_id AND t.sample_id = late.sample_id)
UNION ALL SELECT DISTINCT run_id, 's' || q || '-r01', 1, conv_id % 5 FROM turns WHERE conv_id % 10 = 8)
SELECT run_id, sample_id, row_number() OVER (PARTITION BY run_id ORDER BY i, r, sample_id) AS order_no FROM every""")
def sample_order(spark, sf_dir):
    """L3: samples by question index, their own or else their question's place, then repeat index and id."""
    return imports.ordered_samples(ingest.import_crawl(*_crawls(spark, sf_dir))).select("run_id", "sample_id", F.col("order_no").cast("long").alias("order_no"))


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS run_id, s_name AS n, 'N' || CAST(s_nationkey AS VARCHAR) AS nation FROM supplier)
SELECT run_id, 'target' AS object_id, n AS canonical_name, n || '|' || nation AS aliases, 's' || run_id || '.example.com' AS domains FROM s
UNION ALL SELECT run_id, 'competitor-01', 'Solo', 'Solo|Solo One', 'a.example,b.example' FROM s WHERE k % 2 = 0
UNION ALL SELECT run_id, 'competitor-0' || i, 'Rival ' || i, 'Rival ' || i, '' FROM s, (VALUES ('1'), ('2')) v(i) WHERE k % 2 = 1""")
def flat_configs(spark, sf_dir):
    """Flat configurations, competitors as names or as a single object, aliases as text, as objects, and denied ones."""
    s, k = _suppliers(spark, sf_dir), F.col("k")
    head = F.to_json(
        F.struct(
            F.col("s_name").alias("customer_name"), F.col("nation").alias("aliases"),
            F.concat(F.lit("https://www.s"), "run_id", F.lit(".example.com/")).alias("official_domain")
        )
    )
    single = '{"brand_name": "Solo", "confirmed_aliases": [{"raw_alias": "Solo One"}, {"alias": "No", "confirmed": false}, ""], "official_domains": ["a.example", "www.b.example"]}'
    rivals = F.when(k % 2 == 0, F.lit(single)).otherwise(F.lit('["Rival 1", {"name": " Rival 2 "}]'))
    body = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(', "comps_list": '), rivals, F.lit("}"))
    objects, aliases, domains = ingest.import_objects(s.select("run_id", body.alias("body")))
    names = aliases.groupBy("run_id", "object_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "alias"))), lambda x: x["alias"]), "|").alias("aliases")
    )
    hosts = domains.groupBy("run_id", "object_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("domain_pos", "domain"))), lambda x: x["domain"]), ",").alias("domains")
    )
    rows = objects.join(names, ["run_id", "object_id"], "left").join(hosts, ["run_id", "object_id"], "left")
    return rows.select(
        "run_id", "object_id", "canonical_name", F.coalesce("aliases", F.lit("")).alias("aliases"), F.coalesce("domains", F.lit("")).alias("domains")
    )


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS run_id, s_acctbal / 10000 AS t, s_nationkey AS n FROM supplier),
f(run_id, code, detail, hit) AS (
SELECT run_id, 'NO_TOPIC', NULL, k % 17 = 0 FROM s UNION ALL SELECT run_id, 'ONE_TOPIC', NULL, k % 9 = 0 FROM s UNION ALL
  SELECT run_id, 'MARKET', NULL, k % 4 = 0 FROM s UNION ALL SELECT run_id, 'LANGUAGE', NULL, k % 6 = 0 FROM s
UNION ALL SELECT run_id, 'PLATFORM', NULL, k % 8 = 0 FROM s UNION ALL SELECT run_id, 'COMPETITORS', NULL, k % 5 NOT BETWEEN 1 AND 3 FROM s UNION ALL
  SELECT run_id, 'THRESHOLD', NULL, t NOT BETWEEN 0.5 AND 1 FROM s
UNION ALL SELECT run_id, 'SAMPLE_POLICY', NULL, k % 10 = 3 FROM s UNION ALL SELECT run_id, 'QUOTA_SUM', NULL, n <> 10 AND k % 3 > 0 FROM s UNION ALL
  SELECT run_id, 'NO_NAME', 'target', k % 7 = 0 FROM s
UNION ALL SELECT run_id, 'NO_DOMAIN', 'competitor-0' || CAST(i AS VARCHAR), i <= k % 5 AND i <> 2 FROM s, range(1, 5) r(i) UNION ALL
  SELECT run_id, 'NO_NAME', 'competitor-02', k % 5 >= 2 FROM s
UNION ALL SELECT run_id, 'SHARED_ALIAS', 'n' || CAST(n AS VARCHAR), k % 5 >= 1 AND k % 7 <> 0 FROM s)
SELECT run_id, code, detail FROM f WHERE hit""")
def run_issues(spark, sf_dir):
    """Configurations that no run may start from."""
    s, k = _suppliers(spark, sf_dir), F.col("k")
    brand = F.when(k % 7 > 0, F.struct(F.col("s_name").alias("name"), F.array("nation").alias("aliases"), F.lit("a.example").alias("domain")))
    rival = F.transform(
        F.sequence(F.lit(1), F.lit(4)),
        lambda i: F.struct(F.when(i != 2, F.concat(F.lit("Rival-"), i.cast("string"))).alias("name"), F.when(i == 1, F.lower("nation")).alias("aliases"))
    )
    quotas = F.when(
        k % 3 > 0, F.struct(F.lit(50).alias("total"), F.struct(F.lit(40).alias("generic"), F.col("s_nationkey").alias("branded")).alias("question_type"))
    )
    body = _json(
        topic=F.when(k % 17 > 0, "tools"), topics=F.when(k % 9 == 0, F.array(F.lit("a"), F.lit("b"))),
        target_market=F.when(k % 4 == 0, "DE").when(k % 4 == 1, "USA"), language=F.when(k % 6 == 0, "fr").when(k % 6 == 1, " English"),
        platform=F.when(k % 8 == 0, "other"), brand=brand, competitors=F.slice(rival, F.lit(1), (k % 5).cast("int")), quotas=quotas,
        sentiment_confidence_threshold=F.col("s_acctbal") / 10000, sample_policy=F.when(k % 10 == 3, "all"),
    )
    raw = s.select("run_id", body.alias("body"))
    return imports.run_findings(ingest.import_runs(raw), *ingest.import_objects(raw))
