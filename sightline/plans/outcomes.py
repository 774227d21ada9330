"""Queries over the outcomes of runs: action states, publish checks, exports, decisions and facts shown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text, urls
from ..operators import citations, mentions, results, sampling, sentiment
from ..sources import ingest, tables
from .bound import ANSWERS, JUDGED, METRICS, PAGES, classified, found, judged
from .raw import _crawls, _turns
from .register import ORACLE, query

_SENTIMENT = f"""{ANSWERS}, {JUDGED}, j AS (SELECT a.run_id, a.answer_id, label, status FROM answers a
  JOIN found f ON f.run_id = a.run_id AND f.answer_id = a.answer_id AND f.object_id = 'target' LEFT JOIN judged ON judged.answer_id = a.answer_id WHERE valid),
felt AS (SELECT run_id, count(*) FILTER (status = 'accepted' AND label = 'positive') AS positive, count(*) FILTER (status = 'accepted'
  AND label = 'negative') AS negative, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (coalesce(status <> 'accepted',
  true)) AS unresolved FROM j GROUP BY run_id)"""

#: Citations of pages, under the runs of the answers that they belong to.
_CITED = f"""{PAGES}, cited AS (SELECT a.run_id, c.answer_id, c.citation_no, c.canonical_url, c.source_type FROM classified c
  JOIN answers a ON a.answer_id = c.answer_id),
once AS (SELECT * FROM cited QUALIFY row_number() OVER (PARTITION BY run_id, answer_id, canonical_url ORDER BY citation_no) = 1)"""


def _cited(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    return classified(spark, sf_dir).drop("run_id").join(rows.select("run_id", "answer_id"), "answer_id")


@query(f"""WITH {_SENTIMENT}, {METRICS}, {_CITED},
rates AS (SELECT *, CASE WHEN answers > 0 THEN CAST(mentions AS DOUBLE) / answers END AS rate, CASE
  WHEN mentions > 0 THEN CAST(rank_sum AS DOUBLE) / mentions END AS place FROM metrics),
best AS (SELECT run_id, max(rate) AS best_rate, min(place) AS best_place FROM rates WHERE role = 'competitor' GROUP BY run_id),
absent AS (SELECT a.run_id, count(*) FILTER (f.answer_id IS NULL) AS n FROM answers a
  LEFT JOIN found f ON f.run_id = a.run_id AND f.answer_id = a.answer_id AND object_id = 'target' WHERE valid AND question_type = 'generic' GROUP BY a.run_id),
share AS (SELECT run_id, CAST(count(*) FILTER (source_type = 'brand_official') AS DOUBLE) / count(*) AS official FROM cited GROUP BY run_id),
pages AS (SELECT run_id, least(8, count(DISTINCT canonical_url)) AS pages FROM once WHERE source_type = 'brand_official' GROUP BY run_id),
r AS (SELECT t.run_id, t.answers, rate, place, best_rate, best_place, n, official, coalesce(pages, 0) AS pages, CASE
  WHEN accepted > 0 THEN CAST(positive AS DOUBLE) / accepted END AS positive, CASE WHEN accepted > 0 THEN CAST(negative AS DOUBLE) / accepted END AS negative
  FROM rates t LEFT JOIN best ON best.run_id = t.run_id LEFT JOIN absent ON absent.run_id = t.run_id LEFT JOIN share ON share.run_id = t.run_id LEFT
    JOIN pages ON pages.run_id = t.run_id LEFT JOIN felt ON felt.run_id = t.run_id WHERE t.role = 'target')
SELECT run_id, 'brand_entry' AS direction, CASE WHEN coalesce(best_rate - rate >= 0.10::DOUBLE,
  false) OR coalesce(CAST(n AS DOUBLE) / answers >= 0.20::DOUBLE, false) THEN 'absent' WHEN coalesce(place - best_place >= 1, false) THEN 'position_lag'
  ELSE 'no_significant_gap' END AS state FROM r WHERE answers > 0
UNION ALL SELECT run_id, 'citation_evidence', CASE WHEN official < 0.10::DOUBLE THEN 'weak' WHEN pages <= 2 THEN 'insufficient_coverage' ELSE 'stable' END
  FROM r WHERE official IS NOT NULL
UNION ALL SELECT run_id, 'brand_expression', CASE WHEN negative >= 0.15::DOUBLE THEN 'risk' WHEN positive < 0.50::DOUBLE THEN 'flat' ELSE 'positive' END
  FROM r WHERE positive IS NOT NULL""")
def action_states(spark, sf_dir):
    """P8 on the runs of answers; citations of the same answers."""
    rows, objects, named = found(spark, sf_dir)
    measured = mentions.object_metrics(rows, named, objects)
    cited = _cited(spark, sf_dir, rows)
    pages = citations.top_official_pages(citations.first_of_page(cited))
    chances = results.opportunity_counts(results.opportunities(rows, named))
    return results.action_states(
        measured, results.benchmarks(measured), chances, citations.official_share(cited), pages, sentiment.target_sentiment(rows, named, judged(spark, sf_dir))
    )


@query(f"""WITH {_SENTIMENT}, {METRICS},
r AS (SELECT run_id, count(*) AS designed, count(*) FILTER (valid) AS valid, min(answer_id) AS low, max(answer_id) AS high,
  bool_or(answer_id % 100 = 7) AS changed FROM answers GROUP BY run_id),
v AS (SELECT run_id, sum(CAST(mentions AS DOUBLE) / nullif(all_mentions, 0)) AS total FROM metrics GROUP BY run_id),
open AS (SELECT j.run_id, bool_or(status IS NULL) AS pending FROM j GROUP BY j.run_id),
c AS (SELECT r.*, coalesce(unresolved, 0) AS unresolved, total, coalesce(pending, false) AS pending FROM r LEFT JOIN felt ON felt.run_id = r.run_id
  LEFT JOIN v ON v.run_id = r.run_id LEFT JOIN open ON open.run_id = r.run_id WHERE r.run_id IS NOT NULL)
SELECT run_id, code, CASE code WHEN 'CONFIG_FROZEN' THEN low % 4 <> 1 WHEN 'QUESTION_TOTAL' THEN low % 7 <> 3 WHEN 'VALID_ANSWER_PRESENT' THEN valid > 0
  WHEN 'BATCH_CONSISTENT' THEN high % 3 <> 0 WHEN 'METRIC_INPUT_HASHES' THEN NOT changed
  WHEN 'TARGET_SENTIMENT_COMPLETE' THEN unresolved = 0 WHEN 'VOICE_INVARIANT' THEN total IS NULL OR abs(total - 1) < 1e-9 WHEN 'TASKS_RESOLVED' THEN NOT pending WHEN 'TRACEABILITY_PRESENT' THEN low % 5 <> 2 ELSE true END AS passed, 'blocking' AS severity
FROM c, (VALUES ('CONFIG_FROZEN'), ('QUESTION_TOTAL'), ('VALID_ANSWER_PRESENT'), ('BATCH_CONSISTENT'), ('METRIC_INPUT_HASHES'),
  ('TARGET_SENTIMENT_COMPLETE'), ('OPPORTUNITY_PARTITION'), ('VOICE_INVARIANT'), ('TASKS_RESOLVED'), ('TRACEABILITY_PRESENT')) k(code)""")
def publish_checks(spark, sf_dir):
    """All checks; runs lack a frozen configuration, name another run or use stale hashes by their answers' ids."""
    rows, objects, named = found(spark, sf_dir)
    measured = mentions.object_metrics(rows, named, objects)
    cover = sampling.coverage(rows)
    span = rows.where("run_id is not null").groupBy("run_id").agg(
        F.min("answer_id").alias("low"), F.max("answer_id").alias("high"), F.count("*").alias("designed")
    )
    prints = results.fingerprints(rows, ["answer_id"], "run_id").select("run_id", F.col("fingerprint").alias("used"))
    edited = rows.withColumn("sequence", F.when(F.col("answer_id") % 100 == 7, -1).otherwise(F.col("sequence")))
    now = results.fingerprints(edited, ["answer_id"], "run_id").select("run_id", F.col("fingerprint").alias("current"))
    inputs = prints.join(now, "run_id", "full_outer").withColumn("input", F.lit("answers"))
    runs = span.join(prints, "run_id", "left").select(
        "run_id", F.when(F.col("low") % 7 == 3, F.col("designed") + 1).otherwise(F.col("designed")).alias("quota_total"),
        F.when(F.col("low") % 4 != 1, "c").alias("config_hash"), F.lit("2026-01-01").alias("frozen_at"),
        F.col("used").alias("answers_hash"), F.when(F.col("low") % 5 != 2, "m").alias("metrics_hash"),
    )
    names = F.array(
        F.struct(F.lit("config").alias("artefact"), F.col("run_id").alias("own_run_id")),
        F.struct(F.lit("answers").alias("artefact"), F.when(F.col("high") % 3 == 0, "other").otherwise(F.col("run_id")).alias("own_run_id"))
    )
    artefacts = span.select("run_id", F.explode(names).alias("x")).select("run_id", "x.*")
    work = sentiment.work_list(rows, named).join(judged(spark, sf_dir).select("run_id", "answer_id", "status"), ["run_id", "answer_id"], "left")
    tasks = work.select("run_id", F.when(F.col("status").isNull(), "pending").otherwise("accepted").alias("status"))
    chances = results.opportunity_counts(results.opportunities(rows, named))
    return results.publish_checks(runs, cover, chances, measured, sentiment.target_sentiment(rows, named, judged(spark, sf_dir)), artefacts, inputs, tasks)


@query(f"""WITH {ANSWERS}, {_CITED}, o AS (SELECT run_id, answer_id, string_agg(object_id || ':' || CAST(report_rank AS VARCHAR), ' '
  ORDER BY report_rank) AS objects FROM found GROUP BY run_id, answer_id),
c AS (SELECT run_id, answer_id, string_agg(CAST(citation_no AS VARCHAR) || ':' || source_type, ' ' ORDER BY citation_no) AS citations FROM cited
  WHERE run_id IS NOT NULL GROUP BY run_id, answer_id)
SELECT a.run_id, a.answer_id, coalesce(objects, '') AS objects, coalesce(citations, '') AS citations FROM answers a
  LEFT JOIN o ON o.run_id = a.run_id AND o.answer_id = a.answer_id LEFT JOIN c ON c.run_id = a.run_id AND c.answer_id = a.answer_id""")
def answer_details(spark, sf_dir):
    """Each answer with its objects and citations."""
    rows, _, named = found(spark, sf_dir)
    spelt = lambda items, *parts: F.array_join(
        F.transform(F.coalesce(items, F.array()), lambda x: F.concat_ws(":", *[x[p].cast("string") for p in parts])), " "
    )
    out = results.details(rows, named, _cited(spark, sf_dir, rows))
    return out.select(
        "run_id", "answer_id", spelt(F.col("objects"), "object_id", "report_rank").alias("objects"),
        spelt(F.col("citations"), "citation_no", "source_type").alias("citations")
    )


@query(f"WITH {_SENTIMENT} SELECT run_id, answer_id FROM j WHERE coalesce(status <> 'accepted', true)")
def unresolved_answers(spark, sf_dir):
    """A4: the answers behind the count of unresolved judgements."""
    rows, _, named = found(spark, sf_dir)
    return sentiment.unresolved_answers(rows, named, judged(spark, sf_dir))


#: Hosts by the last digit of a page's id: known ones, their subdomains and look-alikes, institutions, and others.
_HOSTS = (
    "www.reddit.com", "en.wikipedia.org", "data.census.gov", "stats.gov.uk", "cs.example.edu", "anu.edu.au", "notreddit.com", "x.com.evil.net", "old.x.com",
    "shop.example.com"
)
_TYPES = ("ugc", "encyclopedia_reference", "institutional", "institutional", "institutional", "institutional", "other", "other", "ugc", "brand_official")


@query(f"""WITH h(k, host, source_type) AS (VALUES {", ".join(f"({k}, '{h.removeprefix('www.')}', '{t}')" for k, (h, t) in enumerate(zip(_HOSTS, _TYPES)))})
SELECT page_id, h.host, source_type, CASE source_type WHEN 'brand_official' THEN 'official_rule' WHEN 'other' THEN 'default_other'
  ELSE 'domain_rule' END AS classification_source, CASE source_type WHEN 'brand_official' THEN 1.0::DOUBLE WHEN 'other' THEN NULL
  ELSE 0.95::DOUBLE END AS confidence
FROM pages JOIN h ON k = page_id % {len(_HOSTS)}""")
def known_host_classes(spark, sf_dir):
    """Known hosts and institutions, their subdomains and look-alikes."""
    host = F.element_at(F.array(*map(F.lit, _HOSTS)), (F.col("page_id") % len(_HOSTS) + 1).cast("int"))
    pages = tables.read(spark, sf_dir, "pages").select(
        F.lit("r").alias("run_id"), "page_id", F.concat(F.lit("https://"), host, F.lit("/"), F.col("page_id").cast("string")).alias("raw_url")
    )
    return citations.classify(citations.canonical(pages), tables.domains(pages)).select("page_id", "host", "source_type", "classification_source", "confidence")


@query(f"""WITH {PAGES}, w AS (SELECT run_id, host, 'S-' || lpad(CAST(row_number() OVER (PARTITION BY run_id ORDER BY host) AS VARCHAR), 3, '0') AS item_id
  FROM (SELECT DISTINCT run_id, host FROM classified WHERE source_type = 'other'))
SELECT run_id, item_id, CASE length(host) % 4 WHEN 0 THEN 'MISSING' WHEN 1 THEN 'TYPE' WHEN 2 THEN 'RANGE' END AS code FROM w WHERE length(host) % 4 < 3
  UNION ALL SELECT DISTINCT run_id, 'S-999', 'UNEXPECTED' FROM w""")
def decision_issues(spark, sf_dir):
    """Decisions missing, unexpected or out of bounds."""
    work = citations.unknown_hosts(classified(spark, sf_dir))
    k = F.length("host") % 4
    given = work.where(k > 0).select(
        "run_id", "item_id", F.when(k == 1, "brand_official").otherwise("ugc").alias("source_type"), F.when(k == 2, 1.5).otherwise(0.9).alias("confidence")
    )
    extra = work.select("run_id").distinct().select(
        "run_id", F.lit("S-999").alias("item_id"), F.lit("ugc").alias("source_type"), F.lit(0.9).alias("confidence")
    )
    return citations.decision_findings(work, given.unionByName(extra))


@query(f"""WITH {PAGES}, w AS (SELECT run_id, host, 'S-' || lpad(CAST(row_number() OVER (PARTITION BY run_id ORDER BY host) AS VARCHAR), 3, '0') AS item_id
  FROM (SELECT DISTINCT run_id, host FROM classified WHERE source_type = 'other'))
SELECT c.run_id, item_id, 'C-' || CAST(answer_id AS VARCHAR) || '-' || lpad(CAST(citation_no AS VARCHAR), 3, '0') AS citation_id FROM classified c
  JOIN w ON w.run_id = c.run_id AND w.host = c.host WHERE source_type = 'other'""")
def work_citations(spark, sf_dir):
    """The citations that each item of the work list decides."""
    cited = classified(spark, sf_dir)
    return citations.work_citations(cited, citations.unknown_hosts(cited))


@query("""SELECT page_id, host = 'example.com' OR ends_with(host, '.example.com') AS matches
  FROM (SELECT page_id, regexp_replace(rtrim(lower(regexp_extract(url, '^[^:/?#]*://([^/?#]*)', 1)), '.'), '^www\\.', '') AS host FROM pages)""")
def domain_matches(spark, sf_dir):
    """F11."""
    return tables.read(spark, sf_dir, "pages").select("page_id", urls.domain_matches(urls.normalize_host(F.col("url")), F.lit("example.com")).alias("matches"))


@query(f"""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'd' || CAST(p_size AS VARCHAR) WHEN 1 THEN '{fixed.YES}' WHEN 2 THEN '{fixed.NO}'
  WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE '—' END AS shown FROM part""")
def fact_displays(spark, sf_dir):
    """facts with a display of their own, truths, numbers and nothing."""
    size = F.col("p_size").cast("string")
    body = F.when(
        F.col("p_size") % 5 == 0, F.concat(F.lit('{"raw": 1, "display": "d'), size, F.lit('"}'))
    ).when(F.col("p_size") % 5 == 1, "true").when(F.col("p_size") % 5 == 2, "false").when(F.col("p_size") % 5 == 3, size).otherwise("null")
    return tables.read(spark, sf_dir, "part").select("p_partkey", text.fact_display(F.parse_json(body)).alias("shown"))


@query("""SELECT p_partkey, 'Q-' || substr(sha256('{"brand":"' || p_brand || '","name":"' || p_name || '","size":' || CAST(p_size AS VARCHAR) || '}'), 1, 16) AS id FROM part""")
def stable_ids(spark, sf_dir):
    """F16: ids that follow from what they stand for."""
    return tables.read(spark, sf_dir, "part").select("p_partkey", text.stable_id("Q", name=F.col("p_name"), brand=F.col("p_brand"), size=F.col("p_size")).alias("id"))


_SAMPLES = """s AS (SELECT 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, conv_id AS question_id, turn, CAST(conv_id AS VARCHAR) || '-r' || CASE
  WHEN turn < 10 THEN '0' ELSE '' END || CAST(turn AS VARCHAR) AS sample_id, coalesce(role = 'assistant', false) AND coalesce(trim(text) <> '',
  false) AS eligible FROM conversations),
picked AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY run_id, question_id ORDER BY eligible DESC, turn, sample_id) = 1),
asked AS (SELECT DISTINCT run_id, question_id FROM s UNION ALL SELECT DISTINCT run_id, -1 - question_id FROM s WHERE question_id % 10 = 8)"""


@query(f"""WITH {_SAMPLES} SELECT asked.run_id, asked.question_id, coalesce(sample_id, 'none') AS sample_id, coalesce(eligible, false) AS valid FROM asked
  LEFT JOIN picked ON picked.run_id = asked.run_id AND picked.question_id = asked.question_id""")
def selected_answers(spark, sf_dir):
    """One sample for each question, valid only if eligible; some questions have none."""
    samples = tables.samples(spark, sf_dir)
    asked = samples.select("run_id", "question_id").distinct()
    silent = asked.where("question_id % 10 = 8").select("run_id", (-1 - F.col("question_id")).alias("question_id"))
    found_ = sampling.answers(sampling.representative(samples), asked.unionByName(silent))
    return found_.select("run_id", "question_id", F.coalesce("sample_id", F.lit("none")).alias("sample_id"), "valid")


@query(f"""WITH e AS ({ORACLE["crawl_samples"]}), p AS (SELECT 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, sum(CASE WHEN conv_id % 7 < 3 THEN 3
  ELSE 1 END) AS n FROM conversations GROUP BY 1),
c AS (SELECT run_id, count(*) AS n, count(*) FILTER (code = 'OK') AS valid, count(*) FILTER (code IN ('SOURCE_FAILED', 'MISSING_RESULT')) AS failed,
  count(*) FILTER (code = 'PENDING') AS pending FROM e GROUP BY run_id)
SELECT c.run_id, greatest(c.n, CAST(p.n AS BIGINT)) AS planned, c.n - pending AS completed, valid, failed, c.n - valid - failed - pending AS invalid,
  pending FROM c JOIN p ON p.run_id = c.run_id""")
def planned_counts(spark, sf_dir):
    """Samples of imported crawls by status, against plans that are larger in some runs."""
    plan = _turns(spark, sf_dir).select("run_id", F.explode(F.sequence(F.lit(1), F.when(F.col("conv_id") % 7 < 3, 3).otherwise(1))).alias("k"))
    return sampling.crawl_counts(ingest.import_crawl(*_crawls(spark, sf_dir)), plan)


#: What a text begins with, by the turn, and what it is then found to be; a text that is only the beginning counts whole.
_SIGNED = (("", None), ("I'm sorry, but ", "REFUSAL"), ("Unable to comply: ", "REFUSAL"), ("Please log in to your account. ", "LOGIN_REQUIRED"), ("Bad gateway. ", "ERROR_PAGE"))


@query(f"""WITH v(k, head, code) AS (VALUES {", ".join(f"({k}, '{head.replace(chr(39), chr(39) * 2)}', {'NULL' if code is None else repr(code)})" for k, (head, code) in enumerate(_SIGNED))})
SELECT conv_id, turn, coalesce(v.code, CASE WHEN k = 0 AND conv_id % 3 = 0 THEN 'PLACEHOLDER' WHEN coalesce(trim(text, E' \\t\\n\\r'), '') = '' THEN 'EMPTY_ANSWER' END) AS code
FROM conversations JOIN v ON k = turn % {len(_SIGNED)}""")
def signature_validity(spark, sf_dir):
    """Refusals, placeholders, logins and error pages before the texts of turns."""
    k = F.col("turn") % len(_SIGNED)
    head = F.element_at(F.array(*[F.lit(h) for h, _ in _SIGNED]), (k + 1).cast("int"))
    said = F.when((k == 0) & (F.col("conv_id") % 3 == 0), F.lit(" Loading... ")).otherwise(F.concat(head, text.or_empty(F.col("text"))))
    return tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", ingest.validity(said).alias("code"))


@query("""SELECT 'run' || CAST(conv_id % 7 AS VARCHAR) AS run_id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS sample_id FROM conversations WHERE turn % 3 = 0""")
def text_mismatches(spark, sf_dir):
    """Samples whose question text is not that of the question they name."""
    turns = _turns(spark, sf_dir)
    asked = F.when(F.col("turn") % 3 == 0, F.lit("Another question")).otherwise(F.concat(F.lit(" QUESTION\t"), "q"))
    sample = F.struct(
        F.concat_ws("-", "q", F.col("turn").cast("string")).alias("sample_id"), F.col("q").alias("question_id"), asked.alias("question"),
        F.lit("success").alias("status"), F.lit(True).alias("ok"), F.struct(F.struct(F.lit("x").alias("text")).alias("answer")).alias("result"),
    )
    crawls = turns.select("run_id", F.to_json(F.struct(F.array(sample).alias("samples"))).alias("body"))
    known = turns.select("run_id", F.col("q").alias("question_id"), F.concat(F.lit("Question "), "q").alias("question_text")).distinct()
    return ingest.crawl_findings(ingest.import_crawl(crawls, known)).where("code = 'QUESTION_TEXT_MISMATCH'").select("run_id", "sample_id")


#: Reference blocks and what is found in them; {} stands for an object with the page's url.
_BLOCKS = (
    ('{"count": 1, "items": [{}]}', ()), ('{"items": {}}', ()), ('{"count": 1, "items": ["x", {}]}', ("INVALID_REFERENCE_ITEM", "REFERENCE_COUNT_MISMATCH")),
    ('{"count": 3, "items": [{}]}', ("REFERENCE_COUNT_MISMATCH",)), ('{"count": 1}', ("REFERENCE_COUNT_MISMATCH",)), ('{"count": 0, "items": null}', ()),
    ('{"items": {"a": {}}}', ("INVALID_REFERENCE_ITEMS",)), ('{"count": 1, "items": "none"}', ("INVALID_REFERENCE_ITEMS", "REFERENCE_COUNT_MISMATCH")),
    ('{"count": "1", "items": ""}', ()), ('{"count": true, "items": [{}, 1, []]}', ("INVALID_REFERENCE_ITEM", "INVALID_REFERENCE_ITEM", "REFERENCE_COUNT_MISMATCH")),
    ("{}", ()), ('{"count": 0, "items": 5}', ("INVALID_REFERENCE_ITEMS",)),
)


@query(f"""SELECT CAST(page_id AS VARCHAR) AS sample_id, c.code FROM pages, (VALUES
  {", ".join(f"({k}, '{code}')" for k, (_, found) in enumerate(_BLOCKS) for code in found)}) c(k, code) WHERE c.k = page_id % {len(_BLOCKS)}""")
def reference_issue_kinds(spark, sf_dir):
    """Lists that are none, absent or empty, elements that are no objects, and counts that do not agree."""
    pages = tables.read(spark, sf_dir, "pages")
    item = F.to_json(F.struct(F.coalesce("url", F.lit("")).alias("url")))
    own = F.element_at(F.array(*[F.lit(b if b == "{}" or b == '{"items": {}}' else b.replace("{}", "\x01")) for b, _ in _BLOCKS]), (F.col("page_id") % len(_BLOCKS) + 1).cast("int"))
    samples = pages.select(
        F.lit("r").alias("run_id"), F.col("page_id").cast("string").alias("sample_id"), F.lit(True).alias("analysis_eligible"),
        F.try_parse_json(F.replace(own, F.lit("\x01"), item)).alias("references")
    )
    return ingest.reference_findings(samples).select("sample_id", "code")
