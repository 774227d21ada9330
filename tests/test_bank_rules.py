"""Rules of question banks that a wrong reading breaks: each case is a bank, changed in one place, and what follows."""

import copy

import pytest
from test_bank_and_grounding import load, question, valid

from sightline.functions import fixed, text
from sightline.operators import bank

LEGACY = fixed.LEGACY_VERSIONS[0]


def changed(change=None, **config):
    doc = copy.deepcopy(valid())
    doc["config"] |= config
    if change:
        change(doc)
    return doc


def legacy(**config):
    """A sound bank of the older version."""
    doc = changed(**config)
    doc["schema_version"] = LEGACY
    for q in doc["questions"]:
        q["geo_intent"] = "x"
    return doc


def found(spark, *docs):
    rows = bank.findings(load(spark, *docs)).collect()
    return [sorted((r["code"], r["detail"]) for r in rows if r["bank_id"] == f"b{k}") for k in range(len(docs))]


def without(doc, name):
    del doc["config"][name]
    return doc


def test_version_and_shape(spark):
    def inside(doc):
        doc["config"]["schema_version"] = f" {doc.pop('schema_version')} "

    def empty(doc):
        doc["schema_version"], doc["config"]["schema_version"] = "", fixed.CURRENT_VERSION

    shapes = [changed(lambda d, q=q: d.__setitem__("questions", q)) for q in ({}, None, "x", {"a": 1})]
    absent = changed(lambda d: d.pop("questions"))
    got = found(spark, changed(inside), changed(empty), *shapes, absent)
    assert got == [[], []] + [[("QUESTIONS_SHAPE", None)]] * 5
    # As of a current bank, all its rules hold.
    assert ("NO_BRAND", None) in found(spark, changed(inside, brand_name=""))[0]


def test_quotas(spark):
    no_quotas = without(changed(expected_total=4), "quotas")
    no_types = changed(quotas={"funnel_intent": {"decision": 9}})
    crossed = legacy(quotas={"question_type": {"generic": 2, "branded": 2}, "funnel_intent": {"recommendation": 1, "comparison": 2, "decision": 1}, "cross": {"branded": {"comparison": 1}}})
    other = legacy(quotas={"question_type": {"generic": 2, "branded": 2}, "cross": {"other": {"comparison": 1}, "generic": {}}})
    got = found(spark, no_quotas, no_types, crossed, other)
    assert got[0] == [("QUOTA", "question_type:branded"), ("QUOTA", "question_type:generic")]
    # Without quotas of types no type is expected; a current bank's intents are not compared.
    assert [d for c, d in got[1] if c == "QUOTA"] == ["question_type:branded", "question_type:generic"]
    # Only types that `cross` names are compared by intent.
    assert [x for x in got[2] if x[0] == "QUOTA"] == [("QUOTA", "cross.branded:decision")]
    assert [d for c, d in got[3] if c == "QUOTA"] == [
        "cross.generic:comparison", "cross.generic:recommendation", "cross.other:comparison", "funnel_intent:comparison", "funnel_intent:decision", "funnel_intent:recommendation"
    ]


def test_distinct(spark):
    def bare(doc):
        doc["questions"] = [{"question_id": "q1"}]

    def alike(doc):
        for q in doc["questions"]:
            q |= {"audience_role": "Marketing lead", "scenario": "s", "constraint": "c"}

    cases = {
        # Minima that are given are all there are.
        "given": (changed(alike, expected_total=18, min_distinct_counts={"scenarios": 2}), ["scenarios"]),
        "none": (changed(alike, expected_total=18, min_distinct_counts={}), []),
        "null": (changed(alike, expected_total=18, min_distinct_counts=None), ["audience_roles", "constraints", "scenarios"]),
        "no total": (without(changed(alike), "expected_total"), ["audience_roles", "constraints", "scenarios"]),
        "few": (changed(alike, expected_total=17), []),
        "no whole row": (changed(bare, expected_total=18), ["audience_roles", "constraints", "scenarios"]),
        "unknown": (changed(alike, min_distinct_counts={"tones": 1, "roles": 0, "geo_intents": 3}), ["tones"]),
        "unknown in an old bank": (legacy(min_distinct_counts={"geo_intents": 3}), ["geo_intents"]),
    }
    got = found(spark, *[doc for doc, _ in cases.values()])
    assert {n: [d for c, d in g if c == "FEW_DISTINCT"] for n, g in zip(cases, got)} == {n: want for n, (_, want) in cases.items()}


def test_topics(spark):
    twice = changed(topics=[{"topic_id": "Topic-1", "topic": "answer tracking"}, {"topic_id": "topic 1", "topic": "other"}, {"topic_id": " - ", "topic": "z"}])

    def unnamed(doc):
        doc["questions"][0]["topic_id"] = ""

    b = load(spark, twice, legacy(topics=[{"topic_id": "t9", "topic": "never asked"}]))
    assert bank.topic_coverage(b, bank.row_flags(b)).collect() == []
    assert [(r["topic_id"], r["topic"]) for r in b.topics.collect()] == [("topic 1", "answer tracking")]
    got = found(spark, changed(unnamed, topics=twice["config"]["topics"]))[0]
    assert [c for c, _ in got] == ["TOPIC_ID", "TOPIC_TWICE", "UNKNOWN_TOPIC"]


def test_selection(spark):
    four = valid()["config"]["competitor_selection"]
    four["formal_competitors"].append(four["formal_competitors"][0] | {"name": "Quillon"})

    def asks(doc):
        doc["questions"][1]["user_question"] = doc["questions"][1]["monitoring_prompt"] = "Compare AI visibility tools of Quillon and MirthFox"

    got = found(spark, changed(asks, competitor_selection=four), changed(asks))
    assert got == [[("RIVAL_COUNT", None)], [("ENTITY_LEAK", "MirthFox")]]
    b = load(spark, changed(competitor_selection=four))
    assert bank.rival_tiers(b).collect() == [] and bank.rival_coverage(b, bank.row_flags(b)).collect() == []


def test_first_decision_counts(spark):
    decide = lambda d: {"concept": "geo", "decision": d, "source": "candidate", "reason": "r"}
    judged = {"status": "completed", "decisions": [decide("excluded"), decide("required")]}
    assert found(spark, changed(professional_term_assessment=judged))[0] == [("DECISION_CONCEPT", "2"), ("TERMS_DIFFER", None)]


def test_reviews_count_incomplete_rows(spark):
    def more(doc):
        doc["questions"] += [{"quality_checks": {"commercial_intent": True}}, {"quality_checks": {"commercial_intent": "true"}}, "x", question(9, "generic", "decision", "AI visibility?", quality_checks=[])]

    b = load(spark, changed(more), changed(lambda d: d.__setitem__("questions", [])))
    got = {r["bank_id"]: (r["visible"], r["commercial"]) for r in bank.review_counts(b, bank.row_flags(b)).collect()}
    assert got == {"b0": (5, 5), "b1": (0, 0)}


@pytest.mark.parametrize("value, drifts", [(True, False), ("no", False), (1, False), ([0], False), (False, True), (0, True), ("", True), (None, True), ([], True)])
def test_boundary_by_truth(spark, value, drifts):
    def asks(doc):
        doc["questions"][1] |= {"user_question": "Compare AI visibility in web hosting", "monitoring_prompt": "Compare AI visibility in web hosting", "boundary_question": value}

    assert (("CATEGORY_DRIFT", "web hosting") in found(spark, changed(asks))[0]) == drifts


def test_terms(spark):
    specs = {"geo": valid()["config"]["required_term_coverage"]["geo"], "bare": {"terms": [" "], "acronym": "AI", "min_total": 9}, "odd": {"terms": ["x"], "min_total": True, "min_generic": 2.5}}
    b = load(spark, changed(required_term_coverage=specs))
    rows = bank.term_coverage(b, bank.row_flags(b)).collect()
    assert {r["concept"] for r in rows} == {"geo", "odd"} and {(r["measure"], r["minimum"]) for r in rows if r["concept"] == "odd"} == {
        (m, 0) for m in ("total", "generic", "branded", "expanded", "acronym")
    }


def test_warnings(spark):
    def bare(doc):
        doc.pop("schema_version")

    docs = changed(), changed(bare), legacy(excluded_categories=[" "])
    b = load(spark, *docs)
    got = sorted((r["bank_id"], r["code"], r["severity"]) for r in bank.warnings(b, bank.style(bank.row_flags(b))).collect())
    assert got == [("b1", "LEGACY_WITHOUT_VERSION", "warning"), ("b2", "LEGACY_VERSION", "warning"), ("b2", "NO_EXCLUDED_CATEGORIES", "warning")]


def test_digits_of_any_script(spark):
    rows = spark.createDataFrame([("１２ and 3.５%",), ("{{fact:a٣}}",), ("٣",), ("Ⅷ",)], "t string")
    got = rows.select(text.has_free_number(rows["t"]), text.number_tokens(rows["t"])).collect()
    assert [tuple(r) for r in got] == [(True, ["１２", "3.５%"]), (False, []), (True, ["٣"]), (False, [])]
