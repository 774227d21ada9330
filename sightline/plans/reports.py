"""Queries on written reports and judgements: statements, references, claims and evidence that Spark derives from rows of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grounding, results, sentiment
from ..sources import ingest, tables
from .register import query

_FACTS = """facts AS (SELECT DISTINCT user_id AS run_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
allowed AS (SELECT DISTINCT run_id, CAST(k AS VARCHAR) AS token FROM facts UNION SELECT run_id, CAST(k * 100 AS VARCHAR) FROM facts WHERE abs(k) <= 1 UNION
  SELECT run_id, CAST(k * 100 AS VARCHAR) || '%' FROM facts WHERE abs(k) <= 1)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "events").withColumn("run_id", F.col("user_id"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events as sections of their user's payload, each a string that holds JSON."""
    raw = _events(spark, sf_dir).select("run_id", F.to_json(F.struct(F.col("props").alias("overview"))).alias("body"))
    return grounding.flatten(ingest.payload_sections(raw))


@query("""SELECT user_id AS run_id, 'overview' AS section, '/k' AS pointer, json_extract_string(props, '$.k') AS value, count(*) AS n FROM events
  WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY ALL""")
def payload_leaves(spark, sf_dir):
    """S6, F15."""
    return _facts(spark, sf_dir).where("pointer != ''").groupBy("run_id", "section", "pointer", "value").agg(F.count("*").alias("n"))


@query(f"""WITH {_FACTS}, t AS (SELECT user_id AS run_id, event_id AS idx, unnest([CAST(CAST(floor(value) AS BIGINT) AS VARCHAR),
  CAST(event_id % 100 AS VARCHAR) || '%']) AS token FROM events)
SELECT t.run_id, idx, t.token FROM t WHERE NOT EXISTS (SELECT 1 FROM allowed a
  WHERE a.run_id = t.run_id AND a.token IN (t.token, replace(t.token, '%', '')))""")
def ungrounded_numbers(spark, sf_dir):
    """Two numbers of each event against the numbers that its user's payload holds."""
    said = F.format_string("about %s visits, %s%% of all", F.floor("value").cast("string"), (F.col("event_id") % 100).cast("string"))
    statements = _events(spark, sf_dir).select(
        "run_id", F.lit("M02").alias("module_id"), F.lit("items").alias("path"), F.col("event_id").alias("idx"), said.alias("text")
    )
    return grounding.ungrounded_numbers(statements, grounding.allowed_numbers(_facts(spark, sf_dir))).select("run_id", "idx", "token")


@query("""SELECT user_id AS run_id, event_id AS claim_id, code
  FROM (SELECT user_id, event_id, unnest(CASE event_id % 4 WHEN 1 THEN ['REFERENCES_DIFFER'] WHEN 2 THEN ['BARE_NUMBER'] WHEN 3 THEN ['UNKNOWN_FACT']
  ELSE CAST([] AS VARCHAR[]) END) AS code FROM events)""")
def claim_issues(spark, sf_dir):
    """A claim for each event, sound in every fourth."""
    kind = F.col("event_id") % 4
    text = F.when(
        kind == 2, F.concat(F.lit("{{fact:overview.k}} of "), F.floor("value").cast("string"))
    ).when(kind == 3, F.lit("{{fact:overview.z}} of all")).otherwise(F.lit("{{fact:overview.k}} of all"))
    refs = F.when(kind == 1, F.array(F.lit("overview.k"), F.lit("overview"))).when(kind == 3, F.array(F.lit("overview.z"))).otherwise(F.array(F.lit("overview.k")))
    claims = _events(spark, sf_dir).select("run_id", F.col("event_id").alias("claim_id"), text.alias("text"), refs.alias("refs"))
    return grounding.claim_findings(claims, _facts(spark, sf_dir))


@query(r"""WITH s AS (SELECT doc_id AS idx, source AS run_id, coalesce(text, '') AS t, doc_id % 3 AS k FROM documents)
SELECT run_id, idx, 'UNKNOWN_FIELD' AS code FROM s WHERE k = 2 UNION ALL SELECT run_id, idx, 'EMPTY' FROM s WHERE k = 0 AND trim(t, E' \t\n\r') = ''
  UNION ALL SELECT run_id, idx, 'TOO_LONG' FROM s WHERE length(t) > CASE k WHEN 0 THEN 60 WHEN 1 THEN 90 END
UNION ALL SELECT run_id, idx, 'BANNED' FROM s WHERE regexp_matches(t, '```|[Pp][012]') UNION ALL SELECT run_id, idx, 'ADVICE' FROM s
  WHERE k = 1 AND regexp_matches(t, '需|建议|应该|应当')""")
def statement_issues(spark, sf_dir):
    """P26 over whole texts."""
    k = F.col("doc_id") % 3
    statements = tables.read(spark, sf_dir, "documents").select(
        F.col("source").alias("run_id"), F.when(k == 0, "M01").when(k == 1, "M05").otherwise("M99").alias("module_id"),
        F.when(k == 0, "title").otherwise("p0").alias("path"), F.col("doc_id").alias("idx"), F.lit("text").alias("field"), "text",
    )
    return grounding.text_findings(statements).select("run_id", "idx", "code")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as statements of one list in a report; an order is a run."""
    return tables.read(spark, sf_dir, "lineitem").select(
        "*", F.col("l_orderkey").alias("run_id"), F.lit("M03").alias("module_id"), F.lit("items").alias("path"), F.col("l_linenumber").alias("idx"),
        F.lit("text").alias("field"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("text")
    )


@query("""SELECT l_orderkey AS run_id, 'M03' AS module_id, 'items' AS path, 'text' AS field, count(*) AS n, CASE WHEN count(*) < 3 THEN 'TOO_FEW'
  ELSE 'TOO_MANY' END AS code FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 3""")
def shape_issues(spark, sf_dir):
    """P27."""
    return grounding.shape_findings(_lines(spark, sf_dir))


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS run_id, '/items/' || CAST(l_linenumber AS VARCHAR) AS pointer
  FROM lineitem), r AS (SELECT DISTINCT l_orderkey AS run_id, '/items/' || CAST(l_linenumber + CASE WHEN l_quantity < 5 THEN 100
  ELSE 0 END AS VARCHAR) AS pointer FROM lineitem WHERE l_quantity < 40)
SELECT run_id, pointer, 'NO_REFERENCE' AS code FROM (SELECT * FROM s EXCEPT SELECT * FROM r) UNION ALL SELECT run_id, pointer, 'NO_STATEMENT' FROM (SELECT *
  FROM r EXCEPT SELECT * FROM s)""")
def pointer_issues(spark, sf_dir):
    """Lines of small quantity point past the list, those of large ones lack a reference."""
    lines = _lines(spark, sf_dir)
    refs = lines.where("l_quantity < 40").select(
        "run_id", "module_id", F.concat(F.lit("/items/"), (F.col("idx") + F.when(F.col("l_quantity") < 5, 100).otherwise(0)).cast("string")).alias("pointer")
    )
    return grounding.pointer_findings(lines, refs).select("run_id", "pointer", "code")


@query("""SELECT l_orderkey AS run_id, l_linenumber AS line, CASE l_returnflag WHEN 'A' THEN 'fact:order/' || CASE WHEN l_quantity < 25 THEN 'status'
  ELSE 'state' END WHEN 'N' THEN 'module:M03/items/' || CAST(l_linenumber % 3 AS VARCHAR) ELSE CASE l_suppkey % 3 WHEN 0 THEN 'action:R'
  WHEN 1 THEN 'action:A' ELSE 'evidence:E-' || CAST(l_suppkey AS VARCHAR) END END AS ref
  FROM lineitem l
WHERE CASE l_returnflag WHEN 'A' THEN l_quantity >= 25 OR NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) WHEN 'N' THEN NOT EXISTS (SELECT 1
  FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_linenumber = l.l_linenumber % 3) ELSE l_suppkey % 3 > 0 AND NOT EXISTS (SELECT 1
  FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_returnflag = 'A' AND l.l_suppkey % 3 = 1) AND NOT EXISTS (SELECT 1 FROM lineitem m
  WHERE m.l_orderkey = l.l_orderkey AND m.l_suppkey = l.l_suppkey AND m.l_linestatus = 'O' AND l.l_suppkey % 3 = 2) END""")
def unresolved_references(spark, sf_dir):
    """References to facts of the order, to other lines, to evidence of open lines and to actions, a return flag each."""
    lines = _lines(spark, sf_dir)
    orders = tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.lit("order").alias("section"),
        F.try_parse_json(F.to_json(F.struct(F.col("o_orderstatus").alias("status")))).alias("body")
    )
    evidence = F.concat(F.lit("E-"), F.col("l_suppkey").cast("string")).alias("evidence_id")
    ref = F.when(
        F.col("l_returnflag") == "A", F.when(F.col("l_quantity") < 25, "fact:order/status").otherwise("fact:order/state")
    ).when(
        F.col("l_returnflag") == "N", F.concat(F.lit("module:M03/items/"), (F.col("idx") % 3).cast("string"))
    ).when(F.col("l_suppkey") % 3 == 0, "action:R").when(F.col("l_suppkey") % 3 == 1, "action:A").otherwise(F.concat(F.lit("evidence:"), evidence))
    refs = lines.select("run_id", "module_id", F.col("idx").alias("pointer"), ref.alias("ref"))
    directions = lines.select("run_id", F.col("l_returnflag").alias("direction_id"))
    found = grounding.unresolved_references(refs, grounding.flatten(orders), lines, lines.where("l_linestatus = 'O'").select("run_id", evidence), directions)
    return found.select("run_id", F.col("pointer").alias("line"), "ref")


@query("""WITH a AS (SELECT l_orderkey AS run_id, l_returnflag AS direction_id, count(*) AS told, min(l_linestatus) AS m FROM lineitem
  GROUP BY ALL), d AS (SELECT o_orderkey AS run_id, unnest(['A', 'N']) AS direction_id, 'F' AS m FROM orders)
SELECT run_id, direction_id, code FROM (SELECT coalesce(a.run_id, d.run_id) AS run_id, coalesce(a.direction_id, d.direction_id) AS direction_id, CASE
  WHEN coalesce(told, 0) <> 1 THEN 'ACTIONS' WHEN d.run_id IS NULL THEN 'DIRECTIONS' WHEN a.m <> d.m THEN 'SOURCE_MODULE' END AS code FROM a FULL
  JOIN d ON a.run_id = d.run_id AND a.direction_id = d.direction_id) WHERE code IS NOT NULL""")
def action_issues(spark, sf_dir):
    """Lines as actions by return flag, two directions for each order."""
    actions = _lines(spark, sf_dir).select("run_id", F.col("l_returnflag").alias("direction_id"), F.col("l_linestatus").alias("source_module"))
    directions = tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.explode(F.array(F.lit("A"), F.lit("N"))).alias("direction_id"), F.lit("F").alias("source_module")
    )
    return grounding.action_findings(actions, directions)


@query("""SELECT l_orderkey AS run_id, CAST(l_linenumber AS VARCHAR) AS direction_id, 'BLANK:' || CASE WHEN l_discount = 0
  AND l_tax = 0 THEN 'state,posture' WHEN l_discount = 0 THEN 'state' ELSE 'posture' END AS code FROM lineitem WHERE l_discount = 0 OR l_tax = 0
UNION ALL SELECT l_orderkey, NULL, 'TOO_MANY' FROM lineitem GROUP BY l_orderkey HAVING count(*) > 3""")
def direction_issues(spark, sf_dir):
    """P34."""
    blank = lambda c: F.when(F.col(c) != 0, "x").otherwise(" ")
    directions = _lines(spark, sf_dir).select(
        "run_id", F.col("idx").cast("string").alias("direction_id"), F.col("l_returnflag").alias("direction"), blank("l_discount").alias("state"),
        blank("l_tax").alias("posture"), F.lit("e").alias("key_evidence"), F.lit("a").alias("action_template")
    )
    return grounding.direction_findings(directions)


@query("""SELECT l_orderkey AS run_id, 'summary_citation_sources' AS module, 'items' AS path,
  CAST(l_linenumber AS VARCHAR) AS index, 'text' AS field, 'part ' || CAST(l_partkey AS VARCHAR) AS value FROM lineitem""")
def upload_table(spark, sf_dir):
    """S9; the table's order is the column `place` of the operator."""
    return grounding.upload_rows(_lines(spark, sf_dir)).drop("place")


@query("""SELECT source AS run_id, path FROM (SELECT source, unnest(['p0', 'p1', 'p2']) AS path, doc_id, text FROM documents)
  WHERE CASE path WHEN 'p0' THEN doc_id % 2 = 0 WHEN 'p1' THEN true ELSE false END <> (coalesce(trim(text, E' \\t\\n\\r'), '') <> '')""")
def category_parity(spark, sf_dir):
    """Three groups for each source, one with facts, one without, and one by the id's parity."""
    docs = tables.read(spark, sf_dir, "documents")
    each = docs.select(F.concat_ws("|", "source", F.col("doc_id").cast("string")).alias("run_id"), "source", "doc_id", "text")
    body = F.to_json(
        F.struct(
            F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("p0"), F.array(F.lit("b")).alias("p1"),
            F.array().cast("array<string>").alias("p2")
        )
    )
    facts = grounding.flatten(ingest.payload_sections(each.select("run_id", F.to_json(F.struct(body.alias("category_actions"))).alias("body"))))
    statements = each.select(
        "run_id", F.lit("M05").alias("module_id"), F.explode(F.array(*map(F.lit, ("p0", "p1", "p2")))).alias("path"), F.lit(0).alias("idx"),
        F.lit("text").alias("field"), "text"
    )
    return grounding.parity_findings(statements, facts).select(F.regexp_extract("run_id", r"^(.*)\|\d+$", 1).alias("run_id"), "path")


_TRIES = """tries AS (SELECT source AS run_id, l.doc_id AS answer_id, text, a AS attempt, CASE WHEN toxic = 1 THEN 'negative'
  WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label,
  CASE WHEN l.doc_id % 7 = 0 THEN 0.0 WHEN toxic = 1 THEN -0.7 WHEN quality = 1 THEN 0.5
    ELSE 0.0 END AS score, 0.5 + (l.doc_id % 50) / 100.0 + a / 1000.0 AS confidence, CASE WHEN l.doc_id % 5 > 0 THEN CASE
    WHEN l.doc_id % 4 = 3 THEN coalesce(text, '') || '!' WHEN l.doc_id % 4 = 2 THEN str_split(coalesce(text, ''), chr(10))[-1]
    ELSE coalesce(text, '') END END AS quote
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id, range(1, 4) t(a) WHERE a <= l.doc_id % 3 + 1),
last AS (SELECT *, 'E-' || CAST(answer_id AS VARCHAR) || '-01' AS evidence_id FROM tries WHERE attempt = answer_id % 3 + 1)"""


def _tries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(answers, judgements of up to three attempts): a quote is the text, its last line, or words that it does not hold; every fifth judgement has none."""
    answers = tables.answers(spark, sf_dir)
    given = tables.sentiment_results(spark, sf_dir).join(answers.select("run_id", "answer_id", "answer_text"), "answer_id")
    said, k = F.coalesce("answer_text", F.lit("")), F.col("answer_id") % 4
    quote = F.array(F.when(k == 3, F.concat(said, F.lit("!"))).when(k == 2, F.substring_index(said, "\n", -1)).otherwise(said))
    tries = given.withColumn("attempt", F.explode(F.sequence(F.lit(1), (F.col("answer_id") % 3 + 1).cast("int"))))
    tries = tries.withColumn(
        "score", F.when(F.col("answer_id") % 7 == 0, 0.0).otherwise(F.col("score"))
    ).withColumn("confidence", F.col("confidence") + F.col("attempt") / 1000.0).withColumn(
        "evidence", F.when(F.col("answer_id") % 5 > 0, quote).otherwise(F.array().cast("array<string>"))
    )
    return answers, tries.drop("answer_text")


@query(f"""WITH {_TRIES} SELECT run_id, answer_id, attempt, CASE WHEN confidence > 1 THEN 'RANGE' WHEN label <> CASE WHEN score > 0.1 THEN 'positive'
  WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END THEN 'LABEL_SCORE_MISMATCH' WHEN quote IS NULL THEN 'NO_EVIDENCE' WHEN trim(quote,
  E' \\t\\n\\r') = '' OR NOT contains(text, trim(quote, E' \\t\\n\\r')) THEN 'EVIDENCE_NOT_IN_ANSWER' ELSE 'SOUND' END AS finding FROM tries""")
def judgement_issues(spark, sf_dir):
    """P12."""
    answers, tries = _tries(spark, sf_dir)
    return sentiment.with_findings(tries, answers).select(
        "run_id", "answer_id", F.col("attempt").cast("long").alias("attempt"), F.coalesce("finding", F.lit("SOUND")).alias("finding")
    )


@query(f"""WITH {_TRIES} SELECT run_id, answer_id, attempt, label, CASE WHEN confidence >= 0.75 THEN 'accepted' WHEN attempt < 2 THEN 'review'
  ELSE 'unresolved' END AS status FROM last""")
def latest_judgements(spark, sf_dir):
    """W6, P13."""
    return sentiment.routed(sentiment.latest(_tries(spark, sf_dir)[1]), 0.75).select(
        "run_id", "answer_id", F.col("attempt").cast("long").alias("attempt"), "label", "status"
    )


def _proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.evidence(sentiment.routed(sentiment.latest(_tries(spark, sf_dir)[1]), 0.75))


@query(f"WITH {_TRIES} SELECT last.run_id, evidence_id, answer_id, label, quote FROM last WHERE confidence >= 0.75 AND quote IS NOT NULL")
def sentiment_evidence(spark, sf_dir):
    """S14, F16."""
    return _proof(spark, sf_dir)


def _themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A theme for each document: its own evidence and the next document's, all positive."""
    e = lambda k: F.format_string("E-%d-01", F.col("answer_id") + k)
    return tables.answers(spark, sf_dir).select(
        "run_id", (F.col("answer_id") % 50).alias("theme_id"), F.lit("positive").alias("polarity"), F.array(e(0), e(1)).alias("evidence_ids")
    )


_THEMES = f"""{_TRIES}, proof AS (SELECT * FROM last WHERE confidence >= 0.75 AND quote IS NOT NULL), themes AS (SELECT source AS run_id,
  doc_id % 50 AS theme_id, 'E-' || CAST(doc_id + k AS VARCHAR) || '-01' AS evidence_id FROM documents, range(0, 2) r(k))"""


@query(f"""WITH {_THEMES} SELECT t.run_id, theme_id, t.evidence_id, CASE WHEN p.label IS NULL THEN 'UNKNOWN_EVIDENCE' ELSE 'POLARITY' END AS code
  FROM themes t LEFT JOIN proof p ON p.run_id = t.run_id AND p.evidence_id = t.evidence_id WHERE coalesce(p.label, '') <> 'positive'""")
def theme_issues(spark, sf_dir):
    """J11."""
    return sentiment.theme_findings(_themes(spark, sf_dir), _proof(spark, sf_dir))


@query(f"""WITH {_THEMES} SELECT t.run_id, theme_id, count(DISTINCT answer_id) AS support FROM themes t
  JOIN proof p ON p.run_id = t.run_id AND p.evidence_id = t.evidence_id GROUP BY ALL""")
def theme_support(spark, sf_dir):
    """A13."""
    return sentiment.theme_support(_themes(spark, sf_dir), _proof(spark, sf_dir))


@query("""WITH w AS (SELECT source AS run_id, doc_id AS answer_id FROM documents
  WHERE lang = 'en'), r AS (SELECT DISTINCT source AS run_id, l.doc_id AS answer_id FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
SELECT run_id, answer_id, code FROM (SELECT coalesce(w.run_id, r.run_id) AS run_id, coalesce(w.answer_id, r.answer_id) AS answer_id, CASE
  WHEN r.answer_id IS NULL THEN 'MISSING' WHEN w.answer_id IS NULL THEN 'UNEXPECTED' END AS code FROM w FULL
  JOIN r ON w.run_id = r.run_id AND w.answer_id = r.answer_id) WHERE code IS NOT NULL""")
def work_issues(spark, sf_dir):
    """Judgements against a work list of all generic answers."""
    answers, tries = _tries(spark, sf_dir)
    return sentiment.work_findings(answers.where("question_type = 'generic'"), tries)


@query("""SELECT coalesce(l.k, o_orderkey) AS run_id, 'lines' AS metric, computed, CASE WHEN o_orderkey IS NOT NULL THEN 4.0::DOUBLE END AS supplied
  FROM (SELECT l_orderkey AS k, CAST(count(*) AS DOUBLE) AS computed FROM lineitem GROUP BY l_orderkey) l FULL JOIN orders ON o_orderkey = l.k
  WHERE computed IS NULL OR o_orderkey IS NULL OR computed <> 4""")
def metric_differences(spark, sf_dir):
    """Lines of each order against a supplied count."""
    computed = _lines(spark, sf_dir).groupBy("run_id").agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("lines"))
    supplied = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.lit("lines").alias("metric"), F.lit(4.0).alias("value"))
    return results.metric_differences(computed, supplied)


@query("""WITH c AS (SELECT l_orderkey AS k, CAST(sum(l_linenumber) AS DOUBLE) AS v FROM lineitem GROUP BY l_orderkey),
s AS (SELECT k, CASE WHEN k % 997 = 1 THEN v + 1 WHEN k % 997 = 2 THEN v + 1e-12 ELSE v END AS v FROM c WHERE k % 1009 <> 3
  UNION ALL SELECT -k, v FROM c WHERE k % 1013 = 4)
SELECT coalesce(c.k, s.k) AS run_id, 'places' AS metric, c.v AS computed, s.v AS supplied FROM c FULL JOIN s ON c.k = s.k
  WHERE c.v IS NULL OR s.v IS NULL OR abs(c.v - s.v) > 1e-9""")
def metric_reconciliation(spark, sf_dir):
    """Two sides that agree nearly everywhere; some supplied values are off, by much or by rounding, some lacking, some unknown."""
    sums = _lines(spark, sf_dir).groupBy("run_id").agg(F.sum("l_linenumber").cast("double").alias("value")).withColumn("metric", F.lit("places"))
    k = F.col("run_id")
    moved = F.when(k % 997 == 1, F.col("value") + 1).when(k % 997 == 2, F.col("value") + 1e-12).otherwise(F.col("value"))
    supplied = sums.where("run_id % 1009 != 3").withColumn("value", moved).unionByName(sums.where("run_id % 1013 = 4").withColumn("run_id", -k))
    return results.metric_differences(sums, supplied)


@query("""SELECT l_orderkey AS group_id, count(DISTINCT l_suppkey) AS runs, count(*) AS artefacts FROM lineitem
  GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1""")
def batch_issues(spark, sf_dir):
    """Lines of an order as artefacts that should share one supplier."""
    return results.batch_findings(
        _lines(spark, sf_dir).select(F.col("l_orderkey").alias("group_id"), F.col("l_linenumber").alias("artefact"), F.col("l_suppkey").alias("run_id"))
    )
