"""Queries over question banks with faults of every kind: a bank for each part, its faults by the part's key.

Configurations come from a sound one, whose fields a numbered fault spells otherwise; SQL names the findings that
each fault must give. Questions come from the part's columns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import bank, bank_config, bank_findings
from ..sources import tables
from .register import query


def _rival(name: str, tier: str, **more: object) -> dict:
    mode = "standard_evidence_based" if tier == "direct" else "neutral_shared_dimensions_only"
    return {"name": name, "comparability_tier": tier, "comparison_policy": {"mode": mode, "allowed_dimensions": ["x"]}} | more


def _chosen(*rivals: object, status: str = "frozen", count: int = 3) -> dict:
    return {"status": status, "selection_count": count, "formal_competitors": list(rivals)}


def _judged(*decisions: object, **more: object) -> dict:
    return {"status": "completed", "decisions": list(decisions)} | more


def _decision(concept: str, decision: str = "required", source: str = "candidate", reason: str = "r") -> dict:
    return {"concept": concept, "decision": decision, "source": source, "reason": reason}


_ONE, _TWO, _THREE = _rival("Mirth", "direct"), _rival("Dale", "adjacent"), _rival("Umber", "fallback")
_PUMPS = {"pumps": {"terms": ["pump"], "min_total": 1}}
_SOUND: dict = {
    "brand_name": "Orlune", "brand_object_type": "Product", "category_label": "water pump", "aliases": ["OL"], "topics": [
        {"topic_id": "t1", "topic": "noise"}, {"topic_id": "t2", "topic": "price"}
    ], "expected_total": 1,
    "quotas": {"question_type": {"generic": 1, "branded": 2}}, "competitor_selection": _chosen(_ONE, _TWO, _THREE),
    "category_expression_set": {"core_terms": ["pump"], "product_terms": []},
    "target_audiences": ["Buyers"], "required_term_coverage": _PUMPS, "professional_term_assessment": _judged(_decision("pumps")),
}
#: A field without a value here is left out.
_ABSENT = object()
#: Faults: the fields that are spelt otherwise, and the findings that follow as (code, detail).
_FAULTS: tuple[tuple[dict, tuple], ...] = (
    ({}, ()),
    ({"brand_name": " "}, (("NO_BRAND", None),)),
    ({"brand_object_type": "platform"}, (("OBJECT_TYPE", None),)),
    ({"category_label": ""}, (("NO_LABEL", None),)),
    ({"category_label": "lawn mower"}, (("LABEL_MISMATCH", None),)),
    ({"aliases": "OL"}, (("ALIASES_SHAPE", None),)),
    ({"topics": []}, (("NO_TOPICS", None),)),
    (
        {"topics": [{"topic_id": "T-1", "topic": ""}, {"topic_id": "t 1", "topic": "x"}, {"topic": "y"}, "z"]},
        (("TOPIC_TEXT", "1"), ("TOPIC_TWICE", "2"), ("TOPIC_ID", "3"), ("TOPIC_SHAPE", "4"))
    ),
    ({"quotas": {"question_type": {"generic": 1, "branded": 1}}}, (("TOPICS_OVER_QUOTA", None),)),
    ({"quotas": {"question_type": {"branded": 2}, "funnel_intent": {"awareness": 1}}}, (("RETIRED_AWARENESS", None),)),
    ({"expected_total": _ABSENT}, (("COUNT", None),)),
    ({"min_geo_intent_counts": {}, "min_distinct_counts": {"geo_intents": 2}}, (("RETIRED_GEO_COUNTS", None), ("RETIRED_GEO_DISTINCT", None))),
    ({"category_expression_set": _ABSENT}, (("CATEGORY_SHAPE", None),)),
    (
        {"category_expression_set": {"core_terms": "pump", "placeholder_blacklist": "x"}},
        (("CATEGORY_FIELD", "core_terms"), ("CATEGORY_FIELD", "placeholder_blacklist"), ("CATEGORY_EMPTY", None), ("LABEL_MISMATCH", None))
    ),
    ({"target_audiences": "Buyers"}, (("AUDIENCES_SHAPE", None),)),
    ({"target_audiences": ["Buyers", "-", "buyers!"]}, (("AUDIENCE_EMPTY", "2"), ("AUDIENCE_TWICE", "3"))),
    ({"competitor_selection": _ABSENT}, ()),
    ({"competitor_selection": "none"}, (("SELECTION_SHAPE", None),)),
    ({"competitor_selection": _chosen(_ONE, _TWO, _THREE, status="draft", count=2)}, (("NOT_FROZEN", None), ("SELECTION_COUNT", None))),
    ({"competitor_selection": _chosen(_ONE, _rival("", "odd"))}, (("RIVAL_COUNT", None),)),
    (
        {"competitor_selection": _chosen(_ONE, _rival("mirth!", "odd", aliases="x"), "Umber")},
        (("RIVAL_TWICE", "2"), ("RIVAL_ALIASES", "2"), ("RIVAL_TIER", "2"), ("RIVAL_SHAPE", "3"))
    ),
    (
        {"competitor_selection": _chosen(_rival(" ", "direct"), _rival("Dale", "direct", comparison_policy={"mode": "x"}), _rival("Umber", "fallback", comparison_policy=[]))},
        (("RIVAL_NAME", "1"), ("RIVAL_DIMENSIONS", "2"), ("RIVAL_MODE", "2"), ("RIVAL_POLICY", "3"))
    ),
    ({"required_term_coverage": _ABSENT}, (("NO_TERM_COVERAGE", None), ("TERMS_DIFFER", None))),
    ({"required_term_coverage": ["pumps"]}, (("TERMS_SHAPE", None), ("TERMS_DIFFER", None))),
    ({"required_term_coverage": {"pumps": "pump"}}, (("TERM_SHAPE", "pumps"), ("TERMS_DIFFER", None))),
    ({"required_term_coverage": {"pumps": {"terms": [" "]}}}, (("TERM_WITHOUT_WORDS", "pumps"), ("TERMS_DIFFER", None))),
    (
        {"required_term_coverage": {"pumps": {"terms": ["p"], "context_terms": "x", "min_total": -1, "min_generic": True, "min_branded": 1.5}}},
        (("TERM_CONTEXT", "pumps"), ("TERM_MINIMUM", "pumps"), ("TERM_MINIMUM", "pumps"), ("TERM_MINIMUM", "pumps"))
    ),
    ({"required_term_coverage": {"pumps": {"terms": ["p"], "min_expanded": 1, "min_acronym": 2}}}, (("TERM_EXPANDED", "pumps"), ("TERM_ACRONYM", "pumps"))),
    ({"professional_term_assessment": _ABSENT}, (("ASSESSMENT_SHAPE", None),)),
    (
        {"professional_term_assessment": {"status": "open", "decisions": {}}},
        (("NOT_COMPLETED", None), ("DECISIONS_SHAPE", None), ("NO_REASON_FOR_NONE", None), ("TERMS_DIFFER", None))
    ),
    (
        {"professional_term_assessment": _judged(_decision("pumps"), _decision("pumps"), _decision("", "x"), "odd")},
        (("DECISION_CONCEPT", "2"), ("DECISION_CONCEPT", "3"), ("DECISION_SHAPE", "4"))
    ),
    (
        {"professional_term_assessment": _judged(_decision("pumps", source="x", reason=" "), _decision("valves", "maybe"))},
        (("DECISION_SOURCE", "1"), ("DECISION_REASON", "1"), ("DECISION_OUTCOME", "2"))
    ),
    ({"professional_term_assessment": _judged(_decision("pumps", "excluded"))}, (("TERMS_DIFFER", None),)),
    ({"required_term_coverage": {}, "professional_term_assessment": _judged(no_required_terms_reason="none")}, ()),
)


def _spelt(field: str):
    """The JSON of one field, by the bank's fault; null where it is left out."""
    base = [F.lit(json.dumps({field: _SOUND[field]})[1:-1])] if field in _SOUND else [F.lit(None).cast("string")]
    column = F.when(F.lit(False), base[0])
    for k, (fields, _) in enumerate(_FAULTS):
        if field in fields:
            column = column.when(F.col("fault") == k, F.lit(None if fields[field] is _ABSENT else json.dumps({field: fields[field]})[1:-1]).cast("string"))
    return column.otherwise(base[0])


def _configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.spread(tables.read(spark, sf_dir, "part"), "p_partkey").select(
        F.col("p_partkey").cast("string").alias("bank_id"), (F.col("p_partkey") % len(_FAULTS)).alias("fault"),
        (F.floor(F.col("p_partkey") / len(_FAULTS)) % 3).alias("age")
    )
    fields = sorted({*_SOUND, *(f for fields, _ in _FAULTS for f in fields)})
    version = F.when(F.col("age") == 1, fixed.LEGACY_VERSIONS[0]).when(F.col("age") == 2, "other/v9").otherwise(fixed.CURRENT_VERSION)
    body = F.concat(
        F.lit('{"questions": [{}], "schema_version": "'), version, F.lit('", "config": {'), F.concat_ws(", ", *[_spelt(f) for f in fields]), F.lit("}}")
    )
    return part.select("bank_id", body.alias("body"))


#: Findings of the newest version only, and those that no unknown version has.
_NEW_ONLY = (
    "NO_BRAND", "OBJECT_TYPE", "NO_LABEL", "LABEL_MISMATCH", "NO_TOPICS", "TOPIC_TEXT", "TOPIC_TWICE", "TOPIC_ID", "TOPIC_SHAPE", "TOPICS_OVER_QUOTA",
    "RETIRED_AWARENESS", "RETIRED_GEO_COUNTS", "RETIRED_GEO_DISTINCT", "CATEGORY_SHAPE", "CATEGORY_FIELD", "CATEGORY_EMPTY"
)
_ASSESSED_ONLY = (
    "NO_TERM_COVERAGE", "ASSESSMENT_SHAPE", "NOT_COMPLETED", "DECISIONS_SHAPE", "NO_REASON_FOR_NONE", "TERMS_DIFFER", "DECISION_CONCEPT", "DECISION_SHAPE",
    "DECISION_SOURCE", "DECISION_REASON", "DECISION_OUTCOME"
)
_quoted = lambda names: ", ".join(f"'{n}'" for n in names)
_WANTED = ", ".join(f"({k}, '{code}', {'NULL' if detail is None else repr(detail)})" for k, (_, found) in enumerate(_FAULTS) for code, detail in found)


@query(f"""WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS bank_id, p_partkey % {len(_FAULTS)} AS fault, p_partkey // {len(_FAULTS)} % 3 AS age
  FROM part), w(fault, code, detail) AS (VALUES {_WANTED})
SELECT bank_id, code, detail FROM b JOIN w ON w.fault = b.fault
  WHERE (age = 0 OR code NOT IN ({_quoted(_NEW_ONLY)})) AND (age < 2 OR code NOT IN ({_quoted(_ASSESSED_ONLY)}))
UNION ALL SELECT bank_id, 'SCHEMA_VERSION', NULL FROM b WHERE age = 2""")
def bank_config_issues(spark, sf_dir):
    """Every rule of configurations, in three versions."""
    return bank_config.config_findings(bank.load(_configs(spark, sf_dir)).config).select("bank_id", "code", "detail")


def _tiers(fields: dict) -> list[str]:
    """Known tiers of a selection of three competitors."""
    held = fields.get("competitor_selection", _SOUND["competitor_selection"])
    rivals = held["formal_competitors"] if isinstance(held, dict) else []
    return [r["comparability_tier"] for r in rivals if isinstance(r, dict) and r["comparability_tier"] != "odd"] if len(rivals) == 3 else []


_TIERS = ", ".join(f"({k}, '{tier}')" for k, (fields, _) in enumerate(_FAULTS) for tier in _tiers(fields))


@query(f"""WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS bank_id, p_partkey % {len(_FAULTS)} AS fault FROM part),
t(fault, tier) AS (VALUES {_TIERS})
SELECT bank_id, tier, count(*) AS n FROM b JOIN t ON t.fault = b.fault GROUP BY ALL""")
def bank_tiers(spark, sf_dir):
    """Formal competitors by tier."""
    return bank.rival_tiers(bank.load(_configs(spark, sf_dir)))


def _questioned(spark: SparkSession, sf_dir: str) -> bank.Bank:
    return bank.load(_documents(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bank for each brand in each two hundred parts, a question for each part: kind, names, wording, acronyms and labels by its size."""
    name = F.concat_ws("-", "p_brand", F.floor(F.col("p_partkey") / 200).cast("string"))
    # Dealt out by bank before the questions are written, so that all cores write them and none is shuffled.
    p = tables.spread(tables.read(spark, sf_dir, "part").withColumns({"s": F.col("p_size"), "bank_id": name}), "bank_id")
    s = F.col("s")
    say = F.when(s % 2 == 0, F.lit("Which pump is ")).otherwise(F.lit("Compare Orlune "))
    named = F.when(s % 5 == 1, F.lit("with Mirth ")).when(s % 5 == 3, F.lit("with Mirth and Dale ")).otherwise(F.lit(""))
    word = F.when(s % 7 == 0, F.lit("best ")).when(s % 7 == 1, F.lit("most even ")).otherwise(F.lit(""))
    short = F.when(s % 3 == 0, F.lit("for HVP")).when(s % 3 == 1, F.lit("for HVP, a high volume pump,")).otherwise(F.lit("for homes"))
    text = F.concat(say, named, word, short, F.lit(" "), F.col("p_partkey").cast("string"))
    fields = {n: F.lit("x") for n in (*fixed.REQUIRED_FIELDS, *fixed.CURRENT_FIELDS)} | {
        "question_id": F.col("p_partkey").cast("string"), "question_type": F.when(s % 2 == 0, "generic").otherwise("branded"), "funnel_intent": F.when(
            s % 2 == 0, F.when(s % 4 == 0, "recommendation").otherwise("decision")
        ).otherwise("comparison"), "user_question": text, "monitoring_prompt": text,
        "topic_id": F.lit("t1"), "intent_key": F.concat(
            F.lit("key "), (F.floor(F.col("p_partkey") / 2)).cast("string")
        ), "audience_role": F.when(s < 0, "y").otherwise("x"), "scenario": F.concat(F.lit("s"), (s % 4).cast("string")), "constraint": F.col("p_type"), "decision_stage": F.lit("review"),
    }
    question = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    terms = {"hvp": {"terms": ["pump"], "expanded_form": "high volume pump", "acronym": "HVP", "context_terms": ["homes"]}}
    config = _SOUND | {
        "expected_total": 18, "required_term_coverage": terms,
        "category_expression_set": {"core_terms": ["pump"], "placeholder_blacklist": [], "product_terms": []}
    }
    head, tail = json.dumps({"schema_version": fixed.CURRENT_VERSION, "config": config})[:-1] + ', "questions": [', "]}"
    # A bank's questions are one document, as a bank is read: two hundred at most, however many parts there are.
    lists = p.groupBy("bank_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", question.alias("q")))), lambda x: x["q"]), ", ").alias("qs")
    )
    return lists.select("bank_id", F.concat(F.lit(head), "qs", F.lit(tail)).alias("body"))


_Q = """q AS (SELECT p_brand || '-' || CAST(p_partkey // 200 AS VARCHAR) AS bank_id, CAST(p_partkey AS VARCHAR) AS id, p_partkey AS k, p_size AS s,
  p_type AS t, p_size % 2 = 0 AS generic FROM part)"""


@query(f"""WITH {_Q}, n AS (SELECT bank_id, count(*) FILTER (NOT generic) AS compared, count(*) FILTER (s % 5 IN (1, 3)) AS mirth,
  count(*) FILTER (s % 5 = 3) AS dale, count(*) FILTER (NOT generic AND s % 5 = 1) AS solo, count(*) FILTER (NOT generic AND s % 5 = 3) AS multi FROM q
  GROUP BY bank_id)
SELECT bank_id, 'Mirth' AS name, mirth AS all_questions, solo, multi FROM n UNION ALL SELECT bank_id, 'Dale', dale, 0, multi FROM n UNION ALL
  SELECT bank_id, 'Umber', 0, 0, 0 FROM n""")
def bank_rivals(spark, sf_dir):
    """Questions on each formal competitor, alone and with others."""
    b = _questioned(spark, sf_dir)
    return bank.rival_coverage(b, bank.row_flags(b)).select("bank_id", "name", "all_questions", "solo", "multi")


@query(f"""WITH {_Q}, n AS (SELECT bank_id, count(*) FILTER (NOT generic) AS compared, count(*) FILTER (NOT generic AND s % 5 = 1) AS solo FROM q
  GROUP BY bank_id)
SELECT bank_id, 'NO_SOLO_COMPARISON' AS code, v.name AS detail FROM n, (VALUES ('Mirth'), ('Dale'), ('Umber')) v(name)
  WHERE compared >= 3 AND (v.name <> 'Mirth' OR solo < 1)
UNION ALL SELECT bank_id, 'FEW_OTHER_COMPARISONS', NULL FROM n WHERE compared >= 5 AND compared - solo < 2""")
def bank_comparisons(spark, sf_dir):
    """Competitors without a comparison of their own, banks with few others."""
    b = _questioned(spark, sf_dir)
    return bank.comparison_findings(b, bank.row_flags(b)).select("bank_id", "code", "detail")


@query(f"""WITH {_Q}, d AS (SELECT bank_id, 1 AS roles, count(DISTINCT s % 4) AS scenarios,
  count(DISTINCT trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g'))) AS constraints FROM q GROUP BY bank_id)
SELECT bank_id, 'audience_roles' AS detail FROM d UNION ALL SELECT bank_id, 'scenarios' FROM d WHERE scenarios < 3 UNION ALL SELECT bank_id, 'constraints'
  FROM d WHERE constraints < 2""")
def bank_distinct(spark, sf_dir):
    """Dimensions with too few labels."""
    b = _questioned(spark, sf_dir)
    return bank.distinct_findings(b, bank.style(bank.row_flags(b))).select("bank_id", "detail")


@query(f"""WITH {_Q}, n AS (SELECT bank_id, count(*) AS total, count(*) FILTER (s % 7 = 0) AS promotional, count(*) FILTER (s % 7 = 1) AS low FROM q
  GROUP BY bank_id)
SELECT bank_id, promotional, low AS low_confidence, CAST(promotional AS DOUBLE) / total AS promotional_ratio,
  CAST(low AS DOUBLE) / total AS low_confidence_ratio FROM n""")
def bank_wording(spark, sf_dir):
    """Promotional wording and its ratios."""
    return bank.style(bank.row_flags(_questioned(spark, sf_dir))).select(
        "bank_id", "promotional", "low_confidence", "promotional_ratio", "low_confidence_ratio"
    )


@query(f"WITH {_Q} SELECT bank_id, id AS question_id, 'HVP' AS detail FROM q WHERE s % 3 = 0")
def bank_acronyms(spark, sf_dir):
    """P25: acronyms without expansion or context."""
    return bank_findings.row_findings(_documents(spark, sf_dir)).where("code = 'BARE_ACRONYM'").select("bank_id", "question_id", "detail")


@query(f"""WITH {_Q} SELECT bank_id, 'key ' || CAST(k // 2 AS VARCHAR) AS intent_key, id AS question_id FROM q
  QUALIFY count(*) OVER (PARTITION BY bank_id, k // 2) > 1""")
def bank_duplicate_members(spark, sf_dir):
    """The questions behind each intent key that repeats."""
    return bank.duplicate_members(bank.row_flags(_questioned(spark, sf_dir)))


@query(f"""WITH {_Q} SELECT bank_id, i.i AS detail FROM (SELECT DISTINCT bank_id FROM q) b, (VALUES ('recommendation'), ('comparison'), ('decision')) i(i)
WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.bank_id = b.bank_id AND i.i = CASE WHEN NOT generic THEN 'comparison' WHEN s % 4 = 0 THEN 'recommendation'
  ELSE 'decision' END)""")
def bank_intents(spark, sf_dir):
    """Intents that a bank lacks."""
    b = _questioned(spark, sf_dir)
    return bank.intent_findings(b, bank.row_flags(b)).select("bank_id", F.col("detail"))


@query(f"WITH {_Q} SELECT bank_id, count(*) AS total, count(*) FILTER (generic OR s % 3 = 1) AS visible FROM q GROUP BY bank_id")
def bank_visibility(spark, sf_dir):
    """Questions that show their category."""
    b = _questioned(spark, sf_dir)
    flags = bank.row_flags(b)
    shown = bank.visible(b, flags).groupBy("bank_id").agg(F.count("*").alias("visible"))
    return flags.groupBy("bank_id").agg(F.count("*").alias("total")).join(shown, "bank_id", "left").select(
        "bank_id", "total", F.coalesce("visible", F.lit(0)).alias("visible")
    )


#: Questions that break one gate each: (text, other fields, code); the first breaks none.
_GATES: tuple[tuple[str, dict, str], ...] = (
    ("Compare pumps", {}, ""),
    ("What is a pump", {}, "NON_COMMERCIAL"),
    ("Compare brand tracking pumps", {}, "AMBIGUOUS"),
    ("Compare brand monitoring pumps for LLMs", {}, ""),
    ("Compare pumps", {"decision_stage": "odd"}, "BAD_STAGE"),
    ("Compare pumps", {"funnel_intent": "awareness"}, "BAD_INTENT"),
    ("Compare pumps", {"geo_intent": "x"}, "RETIRED_FIELDS"),
    ("Compare pumps", {"monitoring_prompt": "Compare other pumps"}, "PROMPT_DIFFERS"),
    ("Compare pumps", {"intent_key": " - "}, "EMPTY_INTENT_KEY"),
    (" ", {}, "EMPTY_QUESTION"),
    ("Buy pumps", {}, "BARE_ACTION"),
    ("Pumps for homes", {}, "NOT_NATURAL"),
)


def _gate_bank(text: str, fields: dict) -> str:
    """A bank of one question, as JSON."""
    base = {n: "x" for n in (*fixed.REQUIRED_FIELDS, *fixed.CURRENT_FIELDS)} | {
        "question_type": "generic", "funnel_intent": "comparison", "decision_stage": "review", "user_question": text, "monitoring_prompt": text,
        "zh_translation": "问题", "topic_id": "t1", "quality_checks": dict.fromkeys(fixed.QUALITY_FLAGS + fixed.CURRENT_FLAGS, True),
    }
    return json.dumps({"schema_version": fixed.CURRENT_VERSION, "config": _SOUND, "questions": [base | fields]})


@query(f"""WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS bank_id, p_partkey % {len(_GATES)} AS k FROM part),
w(k, code) AS (VALUES {", ".join(f"({k}, '{code}')" for k, (_, _, code) in enumerate(_GATES) if code)}, (10, 'NOT_NATURAL'))
SELECT bank_id, code FROM b JOIN w ON w.k = b.k""")
def bank_gate_issues(spark, sf_dir):
    """One broken gate for each bank."""
    k = F.col("p_partkey") % len(_GATES)
    body = F.element_at(F.array(*[F.lit(_gate_bank(t, f)) for t, f, _ in _GATES]), (k + 1).cast("int"))
    raw = tables.spread(tables.read(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").cast("string").alias("bank_id"), body.alias("body"))
    wanted = {code for _, _, code in _GATES}
    return bank_findings.row_findings(raw).where(F.col("code").isin(*wanted)).select("bank_id", "code")


@query(f"""WITH {_Q}, n AS (SELECT bank_id, count(*) AS total, count(*) FILTER (s % 7 = 0) AS promotional, count(*) FILTER (s % 7 = 1) AS low,
  count(*) FILTER (generic) AS which FROM q GROUP BY bank_id),
l AS (SELECT bank_id, count(*) FILTER (n = 1) AS single FROM (SELECT bank_id, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) AS t, count(*) AS n
  FROM q GROUP BY ALL) GROUP BY bank_id),
c AS (SELECT bank_id, count(*) FILTER (n = 1) AS single FROM (SELECT bank_id, s % 4 AS t, count(*) AS n FROM q GROUP BY ALL) GROUP BY bank_id),
w AS (SELECT n.bank_id, code, severity FROM n JOIN l ON l.bank_id = n.bank_id JOIN c ON c.bank_id = n.bank_id, (VALUES ('PROMOTIONAL'), ('LOW_CONFIDENCE'),
    ('SINGLE_CONSTRAINTS'), ('SINGLE_SCENARIOS'), ('COMMON_OPENERS'), ('DOMINANT_OPENER')) v(code),
  LATERAL (SELECT CASE WHEN code = 'COMMON_OPENERS' AND which > 0.9 * total THEN 'high_risk' ELSE 'warning' END AS severity)
  WHERE total >= 10 AND CASE code WHEN 'PROMOTIONAL' THEN promotional / total > 0.2 WHEN 'LOW_CONFIDENCE' THEN low / total > 0.2
    WHEN 'SINGLE_CONSTRAINTS' THEN l.single / total >= 0.8 WHEN 'SINGLE_SCENARIOS' THEN c.single / total >= 0.8
    WHEN 'COMMON_OPENERS' THEN which / total > 0.75 ELSE greatest(which, total - which) / total > 0.5 END)
SELECT bank_id, code, severity FROM w UNION ALL SELECT bank_id, 'NO_EXCLUDED_CATEGORIES', 'warning' FROM n""")
def bank_warnings(spark, sf_dir):
    """Batches that lack variety, and configurations without excluded categories."""
    found = bank_findings.all_findings(_documents(spark, sf_dir)).where("severity != 'error'")
    return found.select("bank_id", "code", "severity")
