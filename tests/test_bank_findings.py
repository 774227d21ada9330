"""All findings in one pass are those of the rules one by one."""

import copy
import json
from collections import Counter

from test_bank_and_grounding import load, question, valid
from test_bank_rules import changed, legacy

from sightline.operators import bank
from sightline.operators.bank_findings import all_findings


def banks():
    yield valid()
    yield legacy(excluded_categories=[])
    yield changed(lambda d: d.pop("schema_version"), expected_total=18)
    yield changed(lambda d: d.__setitem__("questions", {"a": 1}))
    yield changed(lambda d: d.__setitem__("questions", []))
    yield {"questions": []}

    def mixed(doc):
        doc["questions"] += [
            "junk", {"question_id": "q7"}, copy.deepcopy(doc["questions"][0]), copy.deepcopy(doc["questions"][3]),
            question(8, "branded", "comparison", "Compare GEO of MirthFox, DaleKin and category tools in web hosting", topic_id="odd", zh_translation="x"),
            question(9, "generic", "awareness", "Buy Orlune, best of Sorvane", decision_stage="x", intent_key=" ", geo_intent="y"),
            question(10, "branded", "comparison", "Is Orlune better than DaleKin for AI visibility", quality_checks=[], boundary_question=True),
            question(11, "other", "comparison", "", retrieval_rewrite=""), question(12, "branded", "comparison", "Compare Orlune with UmberJet"),
            question(13, "branded", "comparison", "Compare Orlune and OL Watch"), question(14, "generic", "decision", "Which GEO tool?", title_seed="which geo tool"),
        ]
        doc["questions"][1] |= {"user_question": "Evaluate the x MirthFox", "monitoring_prompt": "y"}

    yield changed(mixed, expected_total=20)
    yield changed(mixed, quotas=None, min_distinct_counts={"scenarios": 99, "tones": 1}, brand_name="")
    old = legacy(quotas={"question_type": {"generic": 1}, "cross": {"branded": {"comparison": 1}, "x": {"y": 2}}})
    mixed(old)
    yield old

    def many(doc):
        doc["questions"] = [question(k, "generic", "decision", f"What is the best AI visibility tool {k}", cluster=f"c{k}", scenario=f"s{k}", constraint="z") for k in range(12)]

    yield changed(many)


def test_one_pass(spark):
    docs = list(banks())
    raw = spark.createDataFrame([(f"b{k}", json.dumps(d)) for k, d in enumerate(docs)] + [("bad", "{")], "bank_id string, body string")
    b = bank.load(raw)
    flags = bank.row_flags(b)
    want = Counter((r["bank_id"], "error", r["code"], r["question_id"], r["detail"]) for r in bank.findings(b, flags).collect())
    want += Counter((r["bank_id"], r["severity"], r["code"], None, None) for r in bank.warnings(b, bank.style(flags)).collect())
    found = all_findings(raw)
    got = Counter(tuple(r) for r in found.select("bank_id", "severity", "code", "question_id", "detail").collect())
    assert got - want == Counter() and want - got == Counter() and len(want) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan ") == 1
    assert all_findings(raw.where("bank_id = ''")).count() == 0 and load(spark, valid()).config.count() == 1
