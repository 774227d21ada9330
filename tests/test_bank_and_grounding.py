import copy
import json

from pyspark.sql import functions as F

from sightline.functions import fixed
from sightline.operators import bank, grounding
from sightline.sources import ingest


def question(k, kind, intent, text, **more):
    base = {f: f"{f} {k}" for f in fixed.REQUIRED_FIELDS} | {
        "question_id": f"q{k}", "question_type": kind, "funnel_intent": intent, "decision_stage": "shortlist", "user_question": text, "monitoring_prompt": text,
        "zh_translation": "问题", "topic_id": "topic 1", "intent_key": f"key {k}"
    }
    return base | {"quality_checks": dict.fromkeys(fixed.QUALITY_FLAGS + fixed.CURRENT_FLAGS, True)} | more


def valid():
    rivals = [
        {"name": n, "aliases": [], "comparability_tier": t, "comparison_policy": {"mode": m, "allowed_dimensions": ["x"]}} for n, t,
        m in (
            ("MirthFox", "direct", "standard_evidence_based"), ("DaleKin", "adjacent", "neutral_shared_dimensions_only"),
            ("UmberJet", "fallback", "neutral_shared_dimensions_only")
        )
    ]
    config = {
        "brand_name": "Orlune", "product_name": "OL Watch", "brand_object_type": "product", "category_label": "AI visibility", "aliases": [],
        "topics": [{"topic_id": "Topic-1", "topic": "answer tracking"}], "target_audiences": ["Marketing lead"],
        "competitors": ["Sorvane"], "competitor_selection": {
            "status": "frozen", "selection_count": 3, "formal_competitors": rivals
        }, "expected_total": 4, "quotas": {"question_type": {"generic": 2, "branded": 2}},
        "category_expression_set": {
            "core_terms": ["AI visibility"], "product_terms": [], "placeholder_blacklist": ["category tools"]
        }, "excluded_categories": ["web hosting"],
        "required_term_coverage": {
            "geo": {
                "terms": ["generative engine optimization", "GEO"], "expanded_form": "generative engine optimization", "acronym": "GEO",
                "context_terms": ["AI visibility"], "min_total": 1
            }
        },
        "professional_term_assessment": {
            "status": "completed", "decisions": [{"concept": "geo", "decision": "required", "source": "category_core", "reason": "core"}]
        },
    }
    return {"schema_version": "overseas-geo-question-bank/v3", "config": config, "questions": [
        question(
            1, "generic", "recommendation", "Which AI visibility platforms support GEO?", audience_role="Marketing lead"
        ), question(2, "generic", "comparison", "Compare AI visibility tools for small teams"),
        question(3, "branded", "comparison", "How does Orlune compare with MirthFox for AI visibility?"), question(
            4, "branded", "decision", "Evaluate the AI visibility product Orlune on answer tracking"
        ),
    ]}


def load(spark, *docs):
    return bank.load(spark.createDataFrame([(f"b{k}", json.dumps(d)) for k, d in enumerate(docs)], "bank_id string, body string"))


def codes(spark, change):
    doc = copy.deepcopy(valid())
    change(doc)
    return sorted({r["code"] for r in bank.findings(load(spark, doc)).collect()})


def test_valid_bank(spark):
    b = load(spark, valid())
    assert bank.findings(b).collect() == []
    flags = bank.row_flags(b)
    assert bank.visible(b, flags).count() == 4 and {(r["tier"], r["n"]) for r in bank.rival_tiers(b).collect()} == {("direct", 1), ("adjacent", 1), ("fallback", 1)}
    assert [
        (r["name"], r["all_questions"], r["solo"], r["multi"]) for r in bank.rival_coverage(b, flags).orderBy("place").collect()
    ] == [("MirthFox", 1, 1, 0), ("DaleKin", 0, 0, 0), ("UmberJet", 0, 0, 0)]
    assert [(r["generic_total"], r["share"]) for r in bank.audience_coverage(b, flags).collect()] == [(1, 0.5)]


def test_mutations(spark):
    def q(k, **more):
        return lambda d: d["questions"][k].update(more)

    both = lambda t: {"user_question": t, "monitoring_prompt": t}
    cases = [
        (q(0, zh_translation="plain"), ["BAD_TRANSLATION"]), (lambda d: d["questions"][0].pop("zh_translation"), ["MISSING_FIELDS"]), (
            q(0, **both("Which Orlune plan suits AI visibility and GEO?")), ["ENTITY_LEAK"]
        ),
        (q(1, **both("Buy AI visibility tools")), ["BARE_ACTION", "NOT_NATURAL"]), (q(1, **both("What is AI visibility")), ["NON_COMMERCIAL"]), (
            q(1, **both("Which category tools show AI visibility?")), ["PLACEHOLDER"]
        ),
        (q(1, **both("Which tools rank well?")), ["CATEGORY_HIDDEN"]), (
            q(1, **both("Which AI visibility web hosting is good?")), ["CATEGORY_DRIFT"]
        ), (q(1, monitoring_prompt="other"), ["PROMPT_DIFFERS"]), (
            q(1, title_seed="compare AI visibility tools for small teams!"), ["REPEATS_FIELD"]
        ),
        (
            q(1, quality_checks={"natural": "true"}), ["QUALITY_CHECKS"]
        ), (q(1, topic_id="none"), ["UNKNOWN_TOPIC"]), (q(1, decision_stage="odd"), ["BAD_STAGE"]), (q(1, geo_intent="x"), ["RETIRED_FIELDS"]), (q(1, intent_key="key 1"), ["DUPLICATE"]),
        (
            q(3, **both("Evaluate the AI visibility product Orlune on tracking")), ["SENTIMENT_TEMPLATE"]
        ), (q(2, **both("How does it compare with MirthFox for AI visibility?")), ["BRAND_MISSING"]), (lambda d: d["questions"].pop(1), ["COUNT", "QUOTA"]),
        (lambda d: d["config"]["competitor_selection"].update(status="draft"), ["NOT_FROZEN"]), (
            lambda d: d["config"]["competitor_selection"]["formal_competitors"][0].update(comparability_tier="odd"), ["RIVAL_TIER"]
        ),
        (
            lambda d: d["config"]["required_term_coverage"]["geo"].update(min_total=3), ["TERM_COVERAGE"]
        ), (q(1, **both("Compare brand tracking and AI visibility tools")), ["AMBIGUOUS"]), (
            q(1, user_question="Compare AI visibility tools", question_type=None), ["PROMPT_DIFFERS", "QUOTA"]
        ),
    ]
    docs = []
    for change, _ in cases:
        doc = copy.deepcopy(valid())
        change(doc)
        docs.append(doc)
    got: dict = {}
    for r in bank.findings(load(spark, *docs)).collect():
        got.setdefault(r["bank_id"], set()).add(r["code"])
    assert {f"b{k}": sorted(got.get(f"b{k}", ())) for k in range(len(cases))} == {f"b{k}": want for k, (_, want) in enumerate(cases)}


def test_style(spark):
    doc = valid()
    doc["questions"] = [
        question(
            k, "generic", "comparison", f"How good is tool {k} for AI visibility?", cluster=f"c {k}", scenario=f"s {k}", constraint="one"
        ) for k in range(10)
    ]
    styles = bank.style(bank.row_flags(load(spark, doc)))
    assert {(r["code"], r["severity"]) for r in bank.style_warnings(styles).collect()} == {
        ("SINGLE_CLUSTERS", "high_risk"), ("SINGLE_SCENARIOS", "warning"), ("COMMON_OPENERS", "high_risk"), ("DOMINANT_OPENER", "warning")
    }
    assert styles.first()["top_opener"] == "how"


PAYLOAD = {
    "overview": {"rate": 0.28, "n": 1234567, "names": ["a", "b"], "note": "since 2021"}, "competitor": json.dumps({"x": {"y": 3}}),
    "category_actions": {"p0": ["do"], "p1": [], "p2": []}, "brand_expression": [True, None], "citation": {}, "question_details": []
}


def facts(spark):
    return grounding.flatten(ingest.payload_sections(spark.createDataFrame([("r", json.dumps(PAYLOAD))], "run_id string, body string")))


def statements(spark, *items):
    return spark.createDataFrame([("r", *i) for i in items], "run_id string, module_id string, path string, idx int, field string, text string")


def test_facts_and_numbers(spark):
    f = facts(spark)
    got = {(r["section"], r["pointer"]): (r["kind"], r["value"]) for r in f.collect()}
    assert got["competitor", "/x/y"] == ("BIGINT", "3") and got["overview", "/names/1"] == ("STRING", "b") and ("overview", "") in got
    allowed = grounding.allowed_numbers(f)
    tokens = {r["token"] for r in allowed.collect()}
    assert {"0.28", "28", "28%", "1.23457e+06", "2021", "2", "3"} <= tokens and not {"1234567", "1"} & tokens - {"1"}
    bad = grounding.ungrounded_numbers(statements(spark, ("M02", "items", 0, "text", "99% and 28% in 2021%")), allowed)
    assert [r["token"] for r in bad.collect()] == ["99%"]


def test_statement_rules(spark):
    s = statements(
        spark, ("M02", "items", 0, "text", "x" * 91), ("M02", "items", 1, "text", " "), ("M05", "p0", None, "text", "建议"), ("M05", "p1", None, "text", "has"),
        ("M05", "p2", None, "text", ""), ("M02", "odd", 0, "text", "x")
    )
    assert {(r["module_id"], r["path"], r["code"]) for r in grounding.text_findings(s).collect()} == {
        ("M02", "items", "TOO_LONG"), ("M02", "items", "EMPTY"), ("M05", "p0", "ADVICE"), ("M02", "odd", "UNKNOWN_FIELD")
    }
    assert {(r["module_id"], r["path"], r["code"]) for r in grounding.shape_findings(s).collect()} == {("M02", "items", "TOO_FEW")}
    assert [r["path"] for r in grounding.parity_findings(s, facts(spark)).collect()] == ["p1"]
    refs = spark.createDataFrame(
        [
            ("r", "M02", "/items/0", "fact:overview/rate"), ("r", "M02", "/items/9", "fact:overview/none"), ("r", "M02", "/items/1", "module:M05/p0"),
            ("r", "M05", "/p0", "evidence:BE-001"), ("r", "M05", "/p1", "action:D-1")
        ],
        "run_id string, module_id string, pointer string, ref string"
    )
    assert {(r["pointer"], r["code"]) for r in grounding.pointer_findings(s, refs).collect()} == {("/items/9", "NO_STATEMENT"), ("/odd/0", "NO_REFERENCE")}
    evidence = spark.createDataFrame([("r", "BE-001")], "run_id string, evidence_id string")
    directions = spark.createDataFrame([("r", "D-2", "M05")], "run_id string, direction_id string, source_module string")
    assert sorted(
        r["ref"] for r in grounding.unresolved_references(refs, facts(spark), s, evidence, directions).collect()
    ) == ["action:D-1", "fact:overview/none"]
    actions = spark.createDataFrame([("r", "D-1", "M05"), ("r", "D-2", "M03")], "run_id string, direction_id string, source_module string")
    assert {
        (r["direction_id"], r["code"]) for r in grounding.action_findings(actions, directions).collect()
    } == {("D-1", "DIRECTIONS"), ("D-2", "SOURCE_MODULE")}


def test_claims(spark):
    claims = spark.createDataFrame(
        [("r", "a", "{{fact:overview.rate}}", ["overview.rate"]), ("r", "b", "{{fact:overview.no}} 5", ["x"])],
        "run_id string, claim_id string, text string, refs array<string>"
    )
    assert {
        (r["claim_id"], r["code"]) for r in grounding.claim_findings(claims, facts(spark)).collect()
    } == {("b", "REFERENCES_DIFFER"), ("b", "BARE_NUMBER"), ("b", "UNKNOWN_FACT")}


def test_upload_table(spark, tmp_path):
    s = statements(
        spark, ("M01", "title", None, "text", "T"), ("M01", "conclusion", None, "text", "no"), ("M01", "points", 0, "text", "a, \"b\""),
        ("M05", "p0", None, "text", "p"), ("M05", "p1", None, "text", ""), ("M05", "p2", None, "text", None), ("M06", "actions", 0, "title", "t"),
        ("M06", "actions", 0, "action", "x")
    )
    rows = grounding.upload_rows(s)
    got = [(r["module"], r["path"], r["index"], r["field"], r["value"]) for r in rows.orderBy("place").collect()]
    assert got == [
        ("summary_overview", "", "", "title", "T"), *[("summary_category_actions", "", "", k, v) for k, v in (("p0", "p"), ("p1", ""), ("p2", ""))],
        ("summary_overview", "points", "0", "text", 'a, "b"'), ("summary_priority_opportunities", "actions", "0", "title", "t"),
        ("summary_priority_opportunities", "actions", "0", "action", "x")
    ]
    grounding.write_upload_csv(rows, f"{tmp_path}/out")
    data = next((tmp_path / "out" / "run_id=r").glob("part*.csv")).read_bytes()
    assert data.startswith("﻿module,path,index,field,value\r\n".encode()) and data.count(b"\r\n") == 8 and b'"a, ""b"""' in data


def test_directions(spark):
    table = spark.createDataFrame(
        [("r", f"D{k}", "a", "b", "c", "d", " " if k == 0 else "e") for k in range(4)],
        "run_id string, direction_id string, direction string, state string, posture string, key_evidence string, action_template string"
    )
    assert {(r["direction_id"], r["code"]) for r in grounding.direction_findings(table).collect()} == {("D0", "BLANK:action_template"), (None, "TOO_MANY")}


def test_acronym_needs_context(spark):
    doc = valid()
    doc["questions"][1].update(user_question="Compare GEO tools", monitoring_prompt="Compare GEO tools")
    found = bank.findings(load(spark, doc)).where(F.col("code") == "BARE_ACRONYM")
    assert [r["question_id"] for r in found.collect()] == ["q2"]


def test_facts_of_any_depth(spark, monkeypatch):
    from sightline.plans import registry, reports

    deep = "end [{"
    for k in range(40):
        deep = {"k": deep} if k % 2 else [k, deep]
    path = "".join("/k" if k % 2 else "/1" for k in reversed(range(40)))
    f = grounding.flatten(ingest.payload_sections(spark.createDataFrame([("r", json.dumps({"overview": deep}))], "run_id string, body string")))
    got = {r["pointer"]: (r["value"], r["size"]) for r in f.collect()}
    assert len(got) == 1 + 40 + 20 and got[path] == ("end [{", None) and got[path.removesuffix("/1")] == (None, 2) and got[path.removesuffix("/1") + "/0"] == ("0", None)
    events = spark.createDataFrame([(7, 1, 3.0, json.dumps({"k": {"x": [{"y": 41}]}}))], "user_id long, event_id long, value double, props string")
    monkeypatch.setattr(registry.tables, "read", lambda *_: events)
    assert {(r["pointer"], r["total"]) for r in registry.fact_leaves(spark, "").collect()} == {("/k/x/0/y", 41)}
    assert "41" in {r["token"] for r in registry.allowed_numbers(spark, "").collect()}
    assert ("/k/x/0/y", "41") in {(r["pointer"], r["value"]) for r in reports.payload_leaves(spark, "").collect()}
