"""Queries over question banks read their table few times, deal it out over all cores and join no questions."""

import json

import pytest

from sightline.operators import bank, bank_findings
from sightline.plans import registry

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


# At most so many readings of the table, and joins.
@pytest.mark.parametrize(
    "name, reads, joins",
    [
        ("bank_row_issues", 1, 0),
        ("bank_duplicates", 1, 0),
        ("bank_terms", 2, 1),
        ("bank_quotas", 2, 0),
        ("bank_audiences", 2, 1),
        ("bank_config_issues", 1, 0),
        ("bank_style", 3, 2),
    ],
)
def test_readings(spark, name, reads, joins):
    plan = _plan(registry.QUERIES[name](spark, SF))
    assert plan.count("Relation [") <= reads and plan.count("Join ") <= joins
    # One small file is dealt out before the banks are written from its rows.
    assert plan.count("RepartitionByExpression") == plan.count("Relation [")


def test_rows_by_themselves(spark):
    """The findings of questions by themselves are those that joins with the banks' lists give, on odd questions too."""
    asked = [{"question_id": "a", "user_question": "Which Acme?", "quality_checks": {"natural": "true", "standalone": True}}, 5, None, "x", [1], {}]
    config = {"brand_name": "Acme", "category_label": "pump", "required_term_coverage": {"p": {"terms": ["pump"], "acronym": "AC"}}, "excluded_categories": ["Acme"]}
    full = dict.fromkeys((*bank.fixed.REQUIRED_FIELDS, *bank.fixed.CURRENT_FIELDS), "x")
    asked += [full | asked[0], full | {"quality_checks": None, "user_question": " AC for Acme "}, full | {"question_type": "generic", "user_question": "What is acme"}]
    docs = [{"schema_version": v, "config": c, "questions": q} for v in (bank.fixed.CURRENT_VERSION, "") for c in (config, {}) for q in (asked, [], "none")]
    raw = spark.createDataFrame([(f"b{k}", json.dumps(d)) for k, d in enumerate(docs)], "bank_id string, body string")
    b = bank.load(raw)
    joined, single = bank.row_findings(b, bank.row_flags(b)), bank_findings.row_findings(raw)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(joined.select("bank_id", "code", "question_id", "detail").collect(), key=key) == sorted(single.collect(), key=key)
    assert single.where("code = 'QUALITY_CHECKS'").count() == 6


def test_quotas_of_unknown_types(spark):
    """Questions without a type are over quota; a dimension without quotas is compared with zero, one that is not named is left out."""
    flags = spark.createDataFrame([("b", None, "decision"), ("b", "generic", "decision"), ("c", "generic", None)], "bank_id string, question_type string, funnel_intent string")
    quotas = spark.createDataFrame(
        [("b", "question_type", "generic", 1), ("b", "question_type", "branded", 2), ("b", "funnel_intent", None, 0)], "bank_id string, dimension string, key string, expected int"
    )
    got = bank.quota_differences(flags, quotas).select("bank_id", "dimension", "key", "actual", "expected").collect()
    assert {tuple(r) for r in got} == {("b", "question_type", None, 1, 0), ("b", "question_type", "branded", 0, 2), ("b", "funnel_intent", "decision", 2, 0)} and len(got) == 3
