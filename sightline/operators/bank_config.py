"""Checks on the configurations of question banks.

A configuration is one document a row, so each rule is a column of that row; lists are checked element by
element within it. Nothing is joined or shuffled. A finding is (bank_id, code, question_id, detail), its
question always null and its detail the field, the place or the name that is meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import contains_name, normalize_name, or_empty, strip

FINDING = "array<struct<code: string, detail: string>>"


def _at(v: Column | str, path: str) -> Column:
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, "variant")


def _text(v: Column | str, path: str) -> Column:
    return strip(or_empty(F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, "string")))


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def given(v: Column) -> Column:
    """Whether a value is there and holds anything."""
    return v.isNotNull() & ~F.to_json(v).isin('""', "[]", "{}", "null", "false", "0", "0.0")


def _items(v: Column) -> Column:
    return F.coalesce(F.when(_is(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>")), F.array().cast("array<variant>"))


def _words(v: Column) -> Column:
    """Elements of a list as stripped text, blanks left out."""
    return F.filter(F.transform(_items(v), lambda x: _text(x, "$")), lambda t: t != "")


def _rules(*pairs: tuple[str, Column], detail: Column | str = "") -> Column:
    """The codes whose rule is broken, in order; an unknown truth is no finding."""
    what = F.lit(detail) if isinstance(detail, str) else detail.cast("string")
    each = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(code).alias("code"), what.alias("detail"))) for code, broken in pairs]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def _each(items: Column, rules) -> Column:
    """Findings of all elements; `rules(element, place)` gives those of one, places count from 1."""
    return F.flatten(F.transform(items, lambda v, k: rules(v, k + 1)))


def _repeats(keys: Column, place: Column) -> Column:
    """Whether the key at `place` stands earlier too."""
    return F.array_position(keys, F.element_at(keys, place.cast("int"))) < place


def _general(now: Column, branded: Column) -> Column:
    version = F.col("version")
    return F.concat(
        _rules(
            ("SCHEMA_VERSION", (or_empty(version) != "") & ~version.isin(fixed.CURRENT_VERSION, *fixed.LEGACY_VERSIONS)),
            ("RETIRED_AWARENESS", now & _at("doc", "$.config.quotas.funnel_intent.awareness").isNotNull()),
            ("RETIRED_GEO_COUNTS", now & _at("doc", "$.config.min_geo_intent_counts").isNotNull()),
            ("RETIRED_GEO_DISTINCT", now & _at("doc", "$.config.min_distinct_counts.geo_intents").isNotNull()),
            ("ALIASES_SHAPE", given(_at("doc", "$.config.aliases")) & ~_is(_at("doc", "$.config.aliases"), "ARRAY")),
            ("NO_BRAND", now & (F.col("brand") == "")),
            ("OBJECT_TYPE", now & ~F.lower("object_type").isin("company", "product")),
            ("COUNT", F.coalesce("expected_total", F.lit(fixed.QUOTA_TOTAL)) != F.col("questions")),
        ),
        _topics(now, branded),
        _category(now),
        _audiences(),
    )


def _topics(now: Column, branded: Column) -> Column:
    topics = _at("doc", "$.config.topics")
    items = _items(topics)
    keys = F.transform(items, lambda t: normalize_name(_text(t, "$.topic_id")))
    distinct = F.size(F.array_distinct(F.filter(keys, lambda k: k != "")))

    def one(t: Column, place: Column) -> Column:
        key = normalize_name(_text(t, "$.topic_id"))
        return F.when(~_is(t, "OBJECT"), _rules(("TOPIC_SHAPE", F.lit(True)), detail=place)).otherwise(
            _rules(("TOPIC_ID", key == ""), ("TOPIC_TWICE", (key != "") & _repeats(keys, place)), ("TOPIC_TEXT", _text(t, "$.topic") == ""), detail=place)
        )

    own = F.concat(_rules(("NO_TOPICS", F.size(items) == 0), ("TOPICS_OVER_QUOTA", (distinct > 0) & (distinct > branded))), _each(items, one))
    return F.when(now, own).otherwise(F.array().cast(FINDING))


def _category(now: Column) -> Column:
    held = _at("doc", "$.config.category_expression_set")
    core, product = (_words(_at(held, f"$.{n}")) for n in ("core_terms", "product_terms"))
    label = F.col("category_label")
    shapes = [
        _rules(
            ("CATEGORY_FIELD", given(_at(held, f"$.{n}")) & ~_is(_at(held, f"$.{n}"), "ARRAY")), detail=n
        ) for n in ("core_terms", "product_terms", "placeholder_blacklist")
    ]
    fits = F.exists(F.concat(core, product), lambda t: contains_name(label, t) | contains_name(t, label))
    inner = F.when(
        _is(held, "OBJECT"), F.concat(*shapes, _rules(("CATEGORY_EMPTY", (F.size(core) == 0) & (F.size(product) == 0))))
    ).otherwise(_rules(("CATEGORY_SHAPE", F.lit(True))))
    own = F.concat(inner, _rules(("NO_LABEL", label == ""), ("LABEL_MISMATCH", (label != "") & given(held) & ~fits)))
    return F.when(now, own).otherwise(F.array().cast(FINDING))


def _audiences() -> Column:
    held = _at("doc", "$.config.target_audiences")
    keys = F.transform(_items(held), lambda a: normalize_name(_text(a, "$")))
    one = lambda a, place: _rules(
        ("AUDIENCE_EMPTY", F.element_at(keys, place.cast("int")) == ""),
        ("AUDIENCE_TWICE", (F.element_at(keys, place.cast("int")) != "") & _repeats(keys, place)), detail=place
    )
    return F.concat(_rules(("AUDIENCES_SHAPE", held.isNotNull() & (F.schema_of_variant(held) != "VOID") & ~_is(held, "ARRAY"))), _each(_items(held), one))


def _rivals() -> Column:
    """A frozen selection of three competitors; each is checked only where there are three."""
    held = _at("doc", "$.config.competitor_selection")
    formal = _items(_at(held, "$.formal_competitors"))
    three = F.when(F.size(formal) == 3, formal).otherwise(F.array().cast("array<variant>"))
    keys = F.transform(three, lambda c: normalize_name(_text(c, "$.name")))

    def one(c: Column, place: Column) -> Column:
        tier, policy = _text(c, "$.comparability_tier"), _at(c, "$.comparison_policy")
        known = tier.isin("direct", "adjacent", "fallback")
        mode = F.when(tier == "direct", "standard_evidence_based").otherwise("neutral_shared_dimensions_only")
        rows = _rules(
            ("RIVAL_NAME", _text(c, "$.name") == ""),
            ("RIVAL_TWICE", (_text(c, "$.name") != "") & _repeats(keys, place)),
            ("RIVAL_ALIASES", given(_at(c, "$.aliases")) & ~_is(_at(c, "$.aliases"), "ARRAY")),
            ("RIVAL_TIER", ~known),
            ("RIVAL_POLICY", ~_is(policy, "OBJECT")),
            ("RIVAL_DIMENSIONS", _is(policy, "OBJECT") & ~_is(_at(policy, "$.allowed_dimensions"), "ARRAY")),
            ("RIVAL_MODE", _is(policy, "OBJECT") & known & ~F.coalesce(F.try_variant_get(policy, "$.mode", "string") == mode, F.lit(False))),
            detail=place,
        )
        return F.when(_is(c, "OBJECT"), rows).otherwise(_rules(("RIVAL_SHAPE", F.lit(True)), detail=place))

    frozen = F.coalesce(F.try_variant_get(held, "$.status", "string") == "frozen", F.lit(False))
    count = F.coalesce(F.try_variant_get(held, "$.selection_count", "int") == 3, F.lit(False))
    whole = _rules(("NOT_FROZEN", ~frozen), ("SELECTION_COUNT", ~count), ("RIVAL_COUNT", F.size(formal) != 3))
    absent = held.isNull() | (F.schema_of_variant(held) == "VOID")
    return F.when(absent, F.array().cast(FINDING)).when(
        ~_is(held, "OBJECT"), _rules(("SELECTION_SHAPE", F.lit(True)))
    ).otherwise(F.concat(whole, _each(three, one)))


MINIMA = ("min_total", "min_generic", "min_branded", "min_expanded", "min_acronym")


def _terms(assessed: Column) -> Column:
    """Terms to be covered, and how they were assessed; the required ones must be the same on both sides."""
    held = _at("doc", "$.config.required_term_coverage")
    specs = F.coalesce(
        F.when(_is(held, "OBJECT"), F.map_entries(F.try_variant_get(held, "$", "map<string,variant>"))),
        F.array().cast("array<struct<key: string, value: variant>>")
    )
    worded = lambda s: _is(s["value"], "OBJECT") & (F.size(_words(_at(s["value"], "$.terms"))) > 0)

    def minimum(v: Column, name: str) -> tuple[Column, Column]:
        """Whether a minimum is malformed, and its value (zero if it is)."""
        given, number = _at(v, f"$.{name}"), F.try_variant_get(v, f"$.{name}", "long")
        bad = given.isNotNull() & ~((F.schema_of_variant(given) == "BIGINT") & (number >= 0))
        return bad, F.when(bad, 0).otherwise(F.coalesce(number, F.lit(0)))

    def one(s: Column, place: Column) -> Column:
        v = s["value"]
        numbers = {n: minimum(v, n) for n in MINIMA}
        rows = F.concat(
            _rules(
                ("TERM_CONTEXT", given(_at(v, "$.context_terms")) & ~_is(_at(v, "$.context_terms"), "ARRAY")),
                *[("TERM_MINIMUM", bad) for bad, _ in numbers.values()], detail=s["key"]
            ),
            _rules(
                ("TERM_EXPANDED", (numbers["min_expanded"][1] > 0) & (_text(v, "$.expanded_form") == "")),
                ("TERM_ACRONYM", (numbers["min_acronym"][1] > 0) & (_text(v, "$.acronym") == "")), detail=s["key"]
            ),
        )
        return F.when(~_is(v, "OBJECT"), _rules(("TERM_SHAPE", F.lit(True)), detail=s["key"])).when(
            ~worded(s), _rules(("TERM_WITHOUT_WORDS", F.lit(True)), detail=s["key"])
        ).otherwise(rows)

    judged = _at("doc", "$.config.professional_term_assessment")
    decisions = _items(_at(judged, "$.decisions"))
    concepts = F.transform(decisions, lambda d: F.when(_is(d, "OBJECT"), _text(d, "$.concept")))

    def decision(d: Column, place: Column) -> Column:
        concept = _text(d, "$.concept")
        rows = _rules(
            ("DECISION_OUTCOME", ~_text(d, "$.decision").isin("required", "excluded")), (
                "DECISION_SOURCE", ~_text(d, "$.source").isin("input_explicit", "category_core", "candidate")
            ), ("DECISION_REASON", _text(d, "$.reason") == ""), detail=place,
        )
        off = (concept == "") | _repeats(concepts, place)
        return F.when(
            ~_is(d, "OBJECT"), _rules(("DECISION_SHAPE", F.lit(True)), detail=place)
        ).when(off, _rules(("DECISION_CONCEPT", F.lit(True)), detail=place)).otherwise(rows)

    # Only the first decision on a concept counts.
    firsts = F.filter(decisions, lambda d, k: _is(d, "OBJECT") & ~F.coalesce(_repeats(concepts, k + 1), F.lit(False)))
    required = F.transform(
        F.filter(firsts, lambda d: (_text(d, "$.decision") == "required") & (_text(d, "$.concept") != "")), lambda d: _text(d, "$.concept")
    )
    covered = F.transform(F.filter(specs, worded), lambda s: s["key"])
    differ = F.array_sort(F.array_distinct(required)) != F.array_sort(F.array_distinct(covered))
    whole = _rules(
        (
            "NOT_COMPLETED", ~F.coalesce(F.try_variant_get(judged, "$.status", "string") == "completed", F.lit(False))
        ), ("DECISIONS_SHAPE", ~_is(_at(judged, "$.decisions"), "ARRAY")),
        ("NO_REASON_FOR_NONE", (F.size(decisions) == 0) & (_text(judged, "$.no_required_terms_reason") == "")), ("TERMS_DIFFER", differ),
    )
    assessment = F.when(_is(judged, "OBJECT"), F.concat(whole, _each(decisions, decision))).otherwise(_rules(("ASSESSMENT_SHAPE", F.lit(True))))
    return F.concat(
        _rules(("NO_TERM_COVERAGE", assessed & held.isNull()), ("TERMS_SHAPE", given(held) & ~_is(held, "OBJECT"))),
        _each(specs, one),
        F.when(assessed, assessment).otherwise(F.array().cast(FINDING)),
    )


def config_codes() -> Column:
    """Findings (code, detail) of a configuration as a column of `bank.load(...).config`: general rules and topics (P33), competitors (P31), terms."""
    now = F.coalesce("current", F.lit(False))
    assessed = F.coalesce(F.col("version").isin(fixed.CURRENT_VERSION, *fixed.LEGACY_VERSIONS), F.lit(False))
    quotas = _at("doc", "$.config.quotas")
    branded = F.when(given(quotas), F.coalesce(F.try_variant_get(quotas, "$.question_type.branded", "int"), F.lit(0))).otherwise(F.lit(fixed.QUOTA_BRANDED))
    return F.concat(_general(now, branded), _rivals(), _terms(assessed))


def config_findings(config: DataFrame) -> DataFrame:
    """Findings of the configurations in `bank.load(...).config`."""
    found = config.select("bank_id", F.explode(config_codes()).alias("x"))
    return found.select("bank_id", "x.code", F.lit(None).cast("string").alias("question_id"), F.nullif("x.detail", F.lit("")).alias("detail"))
