"""Question-bank quality over many banks at once.

`raw(bank_id, body)` holds one bank a row. `load` gives tidy tables; `row_flags` projects every rule of a
row once; the batch rules are grouped aggregates of it. Findings are (bank_id, code, question_id, detail).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions.text import contains_name, entity_pattern, normalize_name, normalize_template, or_empty, ratio, strip
from .bank_config import config_findings, given


class Bank(NamedTuple):
    """Tables of the banks; lists of configurations are exploded, one row an entry."""

    config: DataFrame  # bank_id, version, brand, category_label, object_type, expected_total, questions, current, doc
    rows: DataFrame  # bank_id, row_no, q, fields, and of the bank: current, brand, category_label, object_type, specs, names
    topics: DataFrame  # bank_id, topic_id, topic
    names: DataFrame  # bank_id, kind, owner, name, pattern: brand, product, alias, competitor, formal
    category: DataFrame  # bank_id, kind, term: core_terms, product_terms, placeholder_blacklist, excluded
    terms: DataFrame  # bank_id, concept, terms, expanded_form, acronym, context_terms, min_*
    quotas: DataFrame  # bank_id, dimension, key, expected: question_type, funnel_intent, cross.<type>
    rivals: DataFrame  # bank_id, place, name, terms, tier, mode, has_dimensions
    shapeless: DataFrame  # bank_id of documents whose questions are no list


def _text(v: str, path: str) -> Column:
    return F.try_variant_get(F.col(v), path, "string")


def _texts(v: str, path: str) -> Column:
    return F.coalesce(F.try_variant_get(F.col(v), path, "array<string>"), F.array().cast("array<string>"))


def load(raw: DataFrame) -> Bank:
    """Tables of the banks whose questions are a list; the others are `shapeless`.

    The version is the document's, else its configuration's. Topics without an id, and later ones of the same id,
    are left out; so are competitors of a selection that has not exactly three, terms without words, and minima
    that are no whole numbers from zero on. Further columns of `raw` stay in `config`. `quotas` has the dimensions that are compared: question types (the
    default ones without quotas), and intents and intents of each type named for banks of older versions; a
    compared dimension without any quota has one row without a key.
    """
    more = [c for c in raw.columns if c not in ("bank_id", "body")]
    docs = raw.select("bank_id", F.try_parse_json("body").alias("doc"), *more)
    listed = F.try_variant_get(F.col("doc"), "$.questions", "array<variant>").isNotNull()
    shapeless = docs.where(~listed).select("bank_id")
    version = strip(F.coalesce(F.nullif(_text("doc", "$.schema_version"), F.lit("")), _text("doc", "$.config.schema_version"), F.lit("")))
    docs = docs.where(listed).withColumn("version", version).withColumn("current", F.col("version") == fixed.CURRENT_VERSION)
    config = docs.select(
        "bank_id", "version", strip(or_empty(_text("doc", "$.config.brand_name"))).alias("brand"),
        strip(or_empty(_text("doc", "$.config.category_label"))).alias("category_label"),
        strip(or_empty(_text("doc", "$.config.brand_object_type"))).alias("object_type"),
        F.try_variant_get(F.col("doc"), "$.config.expected_total", "int").alias("expected_total"),
        F.size(F.try_variant_get(F.col("doc"), "$.questions", "array<variant>")).alias("questions"), "current", "doc", *more,
    )
    rows = carried(config, "doc").select("*", F.posexplode(asked("doc")).alias("pos", "x")).select("*", (F.col("pos") + 1).alias("row_no"), "x.q", "x.fields").drop("doc", "pos", "x")
    topics = docs.where("current").select("bank_id", F.explode(_topics()).alias("t")).select("bank_id", "t.*")
    rivals = docs.select("bank_id", F.explode(_formal()).alias("c")).select("bank_id", "c.*")
    names = docs.select("bank_id", F.explode(named()).alias("x")).select("bank_id", "x.*")
    category = docs.select("bank_id", F.explode(_category()).alias("x")).select("bank_id", "x.*")
    terms = docs.select("bank_id", F.explode(_term_specs()).alias("s")).select("bank_id", "s.*")
    quotas = docs.select("bank_id", F.explode(_quotas(F.col("current"))).alias("x")).select("bank_id", "x.*")
    return Bank(config, rows, topics, names, category, terms, quotas, rivals, shapeless)


def carried(config: DataFrame, *more: str) -> DataFrame:
    """What a question's rules need of its bank: it comes with the question, so that no large row is joined to it."""
    return config.select("bank_id", "current", "brand", "category_label", "object_type", _term_specs().alias("specs"), named().alias("names"), *more)


def asked(doc: str) -> Column:
    """The questions of a document as (q, fields): the value itself, and its fields as text, null for what is no object."""
    return F.arrays_zip(
        F.try_variant_get(F.col(doc), "$.questions", "array<variant>").alias("q"), F.try_variant_get(F.col(doc), "$.questions", "array<map<string,string>>").alias("fields")
    )


def _is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def _list(path: str) -> Column:
    return F.coalesce(F.try_variant_get(F.col("doc"), path, "array<variant>"), F.array().cast("array<variant>"))


def _field(v: Column, path: str) -> Column:
    return strip(or_empty(F.try_variant_get(v, path, "string")))


def _strings(v: Column, path: str) -> Column:
    """Elements of a list as stripped text, blanks left out; nothing for what is no list."""
    held = F.coalesce(F.try_variant_get(v, path, "array<string>"), F.array().cast("array<string>"))
    return F.filter(F.transform(held, lambda t: strip(or_empty(t))), lambda t: t != "")


def _topics() -> Column:
    """(topic_id, topic) of a document, each id once."""
    found = F.transform(
        F.filter(_list("$.config.topics"), _is_object),
        lambda t: F.struct(normalize_name(F.try_variant_get(t, "$.topic_id", "string")).alias("topic_id"), _field(t, "$.topic").alias("topic"))
    )
    keys = F.transform(found, lambda t: t["topic_id"])
    return F.filter(found, lambda t, k: (t["topic_id"] != "") & (F.array_position(keys, t["topic_id"]) == k + 1))


def _formal() -> Column:
    """(place, name, terms, tier, mode, has_dimensions) of the competitors of a selection of three."""
    held = _list("$.config.competitor_selection.formal_competitors")

    def one(c: Column, k: Column) -> Column:
        name = _field(c, "$.name")
        return F.struct(
            (k + 1).alias("place"), F.when(name != "", name).otherwise(F.concat(F.lit("formal_competitor_"), (k + 1).cast("string"))).alias("name"),
            F.concat(F.filter(F.array(name), lambda n: n != ""), _strings(c, "$.aliases")).alias("terms"), _field(c, "$.comparability_tier").alias("tier"),
            F.try_variant_get(c, "$.comparison_policy.mode", "string").alias("mode"),
            F.try_variant_get(c, "$.comparison_policy.allowed_dimensions", "array<variant>").isNotNull().alias("has_dimensions"), _is_object(c).alias("whole")
        )

    each = F.filter(F.transform(held, one), lambda c: c["whole"])
    plain = F.transform(each, lambda c: F.struct(*[c[n].alias(n) for n in ("place", "name", "terms", "tier", "mode", "has_dimensions")]))
    return F.when(F.size(held) == 3, plain).otherwise(F.slice(plain, 1, 0))


def _names() -> Column:
    """(kind, owner, name) of all names that a document configures."""
    doc = F.col("doc")

    def one(kind: str, names: Column, owner: Column | None = None) -> Column:
        place = F.lit(None).cast("int") if owner is None else owner
        return F.transform(names, lambda n: F.struct(F.lit(kind).alias("kind"), place.alias("owner"), n.alias("name")))

    own = F.filter(F.array(_field(doc, "$.config.brand_name")), lambda n: n != "")
    product = F.filter(F.array(_field(doc, "$.config.product_name")), lambda n: n != "")
    formal = F.flatten(F.transform(_formal(), lambda c: one("formal", c["terms"], c["place"])))
    return F.concat(
        one("brand", own), one("product", product), one("alias", _strings(doc, "$.config.aliases")), one("competitor", _strings(doc, "$.config.competitors")), formal
    )


def named() -> Column:
    """(kind, owner, name, pattern) of the names of a document that can be found."""
    each = F.transform(_names(), lambda n: F.struct(n["kind"].alias("kind"), n["owner"].alias("owner"), n["name"].alias("name"), entity_pattern(n["name"]).alias("pattern")))
    return F.filter(each, lambda n: n["pattern"].isNotNull())


KINDS = {
    "core_terms": "$.config.category_expression_set.core_terms", "product_terms": "$.config.category_expression_set.product_terms",
    "placeholder_blacklist": "$.config.category_expression_set.placeholder_blacklist", "excluded": "$.config.excluded_categories"
}


def _category() -> Column:
    """(kind, term) of a document's category expressions and excluded categories."""
    one = lambda kind: lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"))
    return F.concat(*[F.transform(_strings(F.col("doc"), path), one(kind)) for kind, path in KINDS.items()])


MINIMA = ("min_total", "min_generic", "min_branded", "min_expanded", "min_acronym")


def _term_specs() -> Column:
    """(concept, terms, expanded_form, acronym, context_terms, minima) of a document's required terms."""
    held = F.map_entries(F.try_variant_get(F.col("doc"), "$.config.required_term_coverage", "map<string,variant>"))

    def minimum(v: Column, name: str) -> Column:
        number = F.try_variant_get(v, f"$.{name}", "int")
        whole = (F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")) == "BIGINT") & (number > 0)
        return F.when(whole, number).otherwise(0).alias(name)

    def one(s: Column) -> Column:
        v = s["value"]
        return F.struct(
            s["key"].alias("concept"), _strings(v, "$.terms").alias("terms"), _field(v, "$.expanded_form").alias("expanded_form"),
            _field(v, "$.acronym").alias("acronym"), _strings(v, "$.context_terms").alias("context_terms"), *[minimum(v, n) for n in MINIMA]
        )

    return F.filter(F.transform(held, one), lambda s: F.size(s["terms"]) > 0)


def _quotas(current: Column) -> Column:
    """(dimension, key, expected) of a document, with a row without a key where a compared dimension has no quota."""
    held = F.try_variant_get(F.col("doc"), "$.config.quotas", "variant")
    none = F.array().cast("array<struct<dimension: string, key: string, expected: int>>")

    def entries(dimension: Column, counts: Column) -> Column:
        rows = F.transform(F.map_entries(counts), lambda e: F.struct(dimension.alias("dimension"), e["key"].alias("key"), e["value"].alias("expected")))
        empty = F.array(F.struct(dimension.alias("dimension"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("expected")))
        return F.coalesce(F.when(F.size(rows) > 0, rows), empty)

    def flat(name: str, default: Column | None = None) -> Column:
        own = F.try_variant_get(held, f"$.{name}", "map<string,int>")
        return entries(F.lit(name), own if default is None else F.when(given(held), own).otherwise(default))

    default = F.create_map(F.lit("generic"), F.lit(fixed.QUOTA_GENERIC), F.lit("branded"), F.lit(fixed.QUOTA_BRANDED))
    cross = F.map_entries(F.try_variant_get(held, "$.cross", "map<string,map<string,int>>"))
    each = F.coalesce(F.flatten(F.transform(cross, lambda e: entries(F.concat(F.lit("cross."), e["key"]), e["value"]))), none)
    return F.concat(flat("question_type", default), F.when(current, none).otherwise(F.concat(flat("funnel_intent"), each)))


def _find(rows: DataFrame, code: str, question: Column | None = None, detail: Column | None = None) -> DataFrame:
    return rows.select(
        "bank_id", F.lit(code).alias("code"), (question if question is not None else F.lit(None)).cast("string").alias("question_id"),
        (detail if detail is not None else F.lit(None)).cast("string").alias("detail")
    )


def completeness(bank: Bank) -> DataFrame:
    """Rows with their missing fields; `fatal` rows leave the pipeline."""
    return with_missing(bank.rows)


def with_missing(rows: DataFrame) -> DataFrame:
    """Add `keys`, `missing` and `fatal` to rows with `fields` and `current`."""
    keys = F.map_keys("fields")
    needed = F.when(
        F.col("current"), F.array(*map(F.lit, fixed.REQUIRED_FIELDS + fixed.CURRENT_FIELDS))
    ).otherwise(F.array(*map(F.lit, (*fixed.REQUIRED_FIELDS, "geo_intent"))))
    missing = F.array_except(needed, F.coalesce(keys, F.array().cast("array<string>")))
    return rows.withColumn("keys", keys).withColumn("missing", missing).withColumn("fatal", F.size(F.array_remove("missing", "zh_translation")) > 0)


FIELDS = (
    "question_id", "question_type", "funnel_intent", "decision_stage", "cluster", "audience_role", "scenario", "constraint", "retrieval_rewrite",
    "evidence_query", "title_seed", "monitoring_prompt", "zh_translation", "topic_id", "intent_key"
)


def _true(v: Column) -> Column:
    """Strictly true: text that spells true is not."""
    return F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), F.lit(False))


def row_flags(bank: Bank) -> DataFrame:
    """Every complete row with its fields and a boolean or list for each row rule."""
    return with_flags(completeness(bank).where("not fatal").drop("fatal"))


def with_flags(rows: DataFrame) -> DataFrame:
    """Add the fields of questions and the rules' flags to rows of `with_missing`."""
    field = lambda f: F.try_element_at("fields", F.lit(f))
    r = rows.select("*", *[field(f).alias(f) for f in FIELDS], strip(or_empty(field("user_question"))).alias("text"))
    r = r.withColumn("norm", normalize_name(F.col("text"))).withColumn("topic_id", normalize_name(F.col("topic_id"))).withColumn("intent_key", normalize_name(F.col("intent_key")))
    for name in ("cluster", "scenario", "constraint", "decision_stage"):
        r = r.withColumn(name, normalize_name(F.col(name)))
    text, now = F.col("text"), F.col("current")
    flags = F.array(*map(F.lit, fixed.QUALITY_FLAGS + fixed.CURRENT_FLAGS))
    wanted = F.when(now, flags).otherwise(F.slice(flags, 1, len(fixed.QUALITY_FLAGS)))
    # Read once: within a function of each flag, the whole map would be read anew for each.
    passed = F.map_keys(F.map_filter(F.try_variant_get(F.col("q"), "$.quality_checks", "map<string,variant>"), lambda k, v: _true(v)))
    zh_type = F.schema_of_variant(F.try_variant_get(F.col("q"), "$.zh_translation", "variant"))
    return r.select(
        "*",
        (F.startswith(normalize_template(text), F.lit("evaluate the ")) & now).alias("is_sentiment"),
        (
            ~F.array_contains("missing", "zh_translation") & ~F.coalesce((zh_type == "STRING") & F.col("zh_translation").rlike(fixed.CJK), F.lit(False))
        ).alias("bad_translation"),
        ((text != "") & ~text.rlike(fixed.CONVERSATIONAL) & ~(now & F.startswith(normalize_template(text), F.lit("evaluate the ")))).alias("not_natural"),
        text.rlike(fixed.BARE_ACTION).alias("bare_action"), (now & text.rlike(fixed.NON_COMMERCIAL)).alias("non_commercial"),
        (text.rlike(fixed.AMBIGUOUS) & ~text.rlike(fixed.CLARIFIER)).alias("ambiguous"),
        *wording(text),
        (strip(or_empty(F.col("monitoring_prompt"))) != text).alias("prompt_differs"), F.filter(
            F.array(*[F.when(normalize_name(F.col(c)) == F.col("norm"), F.lit(c)) for c in ("retrieval_rewrite", "evidence_query", "title_seed")]),
            lambda x: x.isNotNull()
        ).alias("repeats"),
        F.coalesce(F.array_except(wanted, passed), wanted).alias("failed_checks"),
        F.when(now, F.array_intersect(F.col("keys"), F.array(*map(F.lit, fixed.RETIRED_FIELDS)))).otherwise(F.array().cast("array<string>")).alias("retired"),
        (
            now & ~F.coalesce(F.col("funnel_intent").isin("recommendation", "comparison", "decision"), F.lit(False))
        ).alias("bad_intent"), (now & ~F.col("decision_stage").isin(*fixed.DECISION_STAGES)).alias("bad_stage"),
        F.when(F.col("norm") != "", F.split("norm", " ")[0]).alias("opener"),
        F.coalesce(given(F.try_variant_get(F.col("q"), "$.boundary_question", "variant")), F.lit(False)).alias("boundary"),
    )


def wording(text: Column) -> tuple[Column, Column]:
    """`promotional`, and `low_confidence` where it is not: words that only may promote."""
    return text.rlike(fixed.PROMOTIONAL).alias("promotional"), (~text.rlike(fixed.PROMOTIONAL) & text.rlike(fixed.LOW_CONFIDENCE)).alias("low_confidence")


ROW_RULES = ("bad_translation", "not_natural", "bare_action", "non_commercial", "ambiguous", "prompt_differs", "bad_intent", "bad_stage")


def row_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    """Findings of single rows, among them names and terms that a question may not or must hold."""
    missing = completeness(bank).where("size(missing) > 0")
    out = _find(missing, "MISSING_FIELDS", F.try_element_at("fields", F.lit("question_id")), F.array_join("missing", ","))
    rules = F.filter(
        F.array(
            *[F.when(F.col(r), F.lit(r.upper())) for r in ROW_RULES], F.when(F.col("text") == "", "EMPTY_QUESTION"),
            F.when(F.col("current") & (F.col("intent_key") == ""), "EMPTY_INTENT_KEY")
        ),
        lambda x: x.isNotNull()
    )
    out = out.unionByName(flags.select("bank_id", F.explode(rules).alias("code"), "question_id", F.lit(None).cast("string").alias("detail")))
    for name, code in (("repeats", "REPEATS_FIELD"), ("failed_checks", "QUALITY_CHECKS"), ("retired", "RETIRED_FIELDS")):
        out = out.unionByName(_find(flags.where(F.size(name) > 0), code, F.col("question_id"), F.array_join(name, ",")))
    off = flags.where("current").join(bank.topics, ["bank_id", "topic_id"], "left_anti")
    out = out.unionByName(_find(off, "UNKNOWN_TOPIC", F.col("question_id"), F.col("topic_id")))
    return out.unionByName(_template_findings(bank, flags)).unionByName(_name_findings(bank, flags)).unionByName(_category_findings(bank, flags)).unionByName(_acronym_findings(flags))


def _template_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    """Brand-sentiment questions: exact wording, branded, of intent decision."""
    rows = flags.where("is_sentiment").join(bank.topics, ["bank_id", "topic_id"], "left")
    expected = _expected_sentiment(F.col("topic"))
    codes = F.filter(
        F.array(
            F.when(normalize_template(F.col("text")) != normalize_template(expected), "SENTIMENT_TEMPLATE"),
            F.when(~F.coalesce(F.col("question_type") == "branded", F.lit(False)), "SENTIMENT_TYPE"),
            F.when(~F.coalesce(F.col("funnel_intent") == "decision", F.lit(False)), "SENTIMENT_INTENT")
        ),
        lambda x: x.isNotNull()
    )
    return rows.select("bank_id", F.explode(codes).alias("code"), "question_id", F.lit(None).cast("string").alias("detail"))


def entity_hits(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, row_no, question_id, question_type, funnel_intent, is_sentiment, kind, owner, name) of names in questions."""
    # A question brings its bank's names: joined to them, all questions could be taken for few enough to broadcast.
    cols = ["row_no", "question_id", "question_type", "funnel_intent", "is_sentiment"]
    found = F.explode(F.filter("names", lambda n: F.rlike("text", n["pattern"]))).alias("n")
    return flags.select("bank_id", *cols, found).select("bank_id", *cols, "n.kind", "n.owner", "n.name")


def _name_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    hits = entity_hits(bank, flags)
    listed = lambda rows: rows.groupBy("bank_id", "row_no", "question_id").agg(
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names")
    )
    leaks = listed(hits.where("question_type = 'generic'"))
    rivals = listed(hits.where("is_sentiment and kind in ('competitor', 'formal')"))
    named = hits.where("kind = 'brand'").select("bank_id", "row_no")
    silent = flags.where("question_type = 'branded' and brand != ''").join(named, ["bank_id", "row_no"], "left_anti")
    return _find(leaks, "ENTITY_LEAK", F.col("question_id"), F.col("names")).unionByName(
        _find(rivals, "SENTIMENT_COMPETITOR", F.col("question_id"), F.col("names"))
    ).unionByName(_find(silent, "BRAND_MISSING", F.col("question_id")))


def _category_hits(bank: Bank, flags: DataFrame) -> DataFrame:
    return flags.select(
        "bank_id", "row_no", "question_id", "text", "boundary", "current"
    ).join(bank.category, "bank_id").where(contains_name(F.col("text"), F.col("term")))


def visible(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, row_no) of questions that show their category."""
    return _category_hits(bank, flags).where("current and kind in ('core_terms', 'product_terms')").select("bank_id", "row_no").distinct()


def _category_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    hits = _category_hits(bank, flags)
    hidden = flags.where("current").join(visible(bank, flags), ["bank_id", "row_no"], "left_anti")
    return (
        _find(hits.where("current and kind = 'placeholder_blacklist'"), "PLACEHOLDER", F.col("question_id"), F.col("term"))
        .unionByName(_find(hits.where("kind = 'excluded' and not boundary"), "CATEGORY_DRIFT", F.col("question_id"), F.col("term")))
        .unionByName(_find(hidden, "CATEGORY_HIDDEN", F.col("question_id")))
    )


def _term_hits(flags: DataFrame) -> DataFrame:
    joined = flags.select("bank_id", "row_no", "question_id", "question_type", "text", F.explode("specs").alias("s")).select("*", "s.*").drop("s")
    any_of = lambda c: F.exists(c, lambda t: contains_name(F.col("text"), t))
    return joined.withColumn("hit", any_of("terms")).withColumn(
        "has_expanded", contains_name(F.col("text"), F.col("expanded_form"))
    ).withColumn("has_acronym", contains_name(F.col("text"), F.col("acronym"))).withColumn("has_context", any_of("context_terms"))


def _acronym_findings(flags: DataFrame) -> DataFrame:
    """Acronyms without expansion or context (P25)."""
    bare = _term_hits(flags).where("has_acronym and not has_expanded and not has_context")
    return _find(bare, "BARE_ACRONYM", F.col("question_id"), F.col("acronym"))


def term_coverage(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, concept, measure, actual, minimum) of each concept's five counts."""
    n = F.count_if
    counts = _term_hits(flags).groupBy("bank_id", "concept").agg(
        n("hit").alias("n_total"), n(F.col("hit") & (F.col("question_type") == "generic")).alias("n_generic"),
        n(F.col("hit") & (F.col("question_type") == "branded")).alias("n_branded"), n("has_expanded").alias("n_expanded"), n("has_acronym").alias("n_acronym")
    )
    rows = bank.terms.join(counts, ["bank_id", "concept"], "left")
    measures = ("total", "generic", "branded", "expanded", "acronym")
    return rows.select(
        "bank_id", "concept",
        F.explode(
            F.array(
                *[F.struct(F.lit(m).alias("measure"), F.coalesce(f"n_{m}", F.lit(0)).alias("actual"), F.col(f"min_{m}").alias("minimum")) for m in measures]
            )
        ).alias("x")
    ).select("bank_id", "concept", "x.*")


def quota_differences(flags: DataFrame, quotas: DataFrame) -> DataFrame:
    """(bank_id, dimension, key, actual, expected) wherever counts and quotas differ, either way.

    Compared are the dimensions that `quotas` has for the bank: question_type, funnel_intent, cross.<type>.
    """
    sets = flags.select("bank_id", "question_type", "funnel_intent").groupBy("bank_id", "question_type", "funnel_intent").agg(F.count("*").alias("n"))
    of = lambda dimension, key: F.struct(dimension.alias("dimension"), key.alias("key"))
    each = sets.select(
        "bank_id", "n", F.explode(
            F.array(
                of(F.lit("question_type"), F.col("question_type")), of(F.lit("funnel_intent"), F.col("funnel_intent")),
                # Of other types no intents are counted.
                of(F.when(F.col("question_type").isin("generic", "branded"), F.concat(F.lit("cross."), "question_type")), F.col("funnel_intent"))
            )
        ).alias("x")
    )
    actual = each.groupBy("bank_id", F.col("x.dimension").alias("dimension"), F.col("x.key").alias("key")).agg(F.sum("n").alias("actual"))
    # Counts and quotas are brought together by one grouping, so that neither side is read twice; a quota that is given twice is compared twice.
    both = actual.withColumn("expected", F.lit(None).cast("int")).unionByName(quotas.select("bank_id", "dimension", "key", F.lit(None).cast("long").alias("actual"), "expected"))
    keyed = both.groupBy("bank_id", "dimension", "key").agg(F.coalesce(F.sum("actual"), F.lit(0)).alias("actual"), F.collect_list("expected").alias("quotas"))
    compared = F.max(F.size("quotas")).over(Window.partitionBy("bank_id", "dimension")) > 0
    known = keyed.withColumn("compared", compared).where("compared and dimension is not null")
    both = known.select("bank_id", "dimension", "key", "actual", F.explode(F.when(F.size("quotas") > 0, F.col("quotas")).otherwise(F.array(F.lit(0)))).alias("expected"))
    return both.where("actual != expected")


def duplicates(flags: DataFrame) -> DataFrame:
    """(bank_id, what, key, n) of ids, questions and intent keys that occur more than once."""
    keys = F.array(
        *[
            F.struct(F.lit(w).alias("what"), k.alias("key")) for w,
            k in (("question_id", F.col("question_id")), ("question", F.col("norm")), ("intent_key", F.when(F.col("current"), F.col("intent_key"))))
        ]
    )
    rows = flags.select("bank_id", F.explode(keys).alias("x")).select("bank_id", "x.*").where("key is not null and key != ''")
    return rows.groupBy("bank_id", "what", "key").agg(F.count("*").alias("n")).where("n > 1")


def duplicate_members(flags: DataFrame) -> DataFrame:
    """(bank_id, intent_key, question_id): a row for each question whose intent key others share."""
    twice = duplicates(flags).where("what = 'intent_key'").select("bank_id", F.col("key").alias("intent_key"))
    return flags.where("current").join(twice, ["bank_id", "intent_key"], "left_semi").select("bank_id", "intent_key", "question_id")


def topic_coverage(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, topic_id, n): topics of current banks without exactly one brand-sentiment question."""
    counts = flags.where("is_sentiment").groupBy("bank_id", "topic_id").agg(F.count("*").alias("n"))
    return bank.topics.select("bank_id", "topic_id").join(counts, ["bank_id", "topic_id"], "left").fillna(0, ["n"]).where("n != 1")


def rival_coverage(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, name, all_questions, solo, multi): questions on each formal competitor."""
    hits = entity_hits(bank, flags).where("kind = 'formal'").select("bank_id", "row_no", "owner", "question_type", "funnel_intent").distinct()
    hits = hits.withColumn("named", F.count("*").over(Window.partitionBy("bank_id", "row_no")))
    compared = (F.col("question_type") == "branded") & (F.col("funnel_intent") == "comparison")
    counts = {"all_questions": F.lit(1), "solo": (compared & (F.col("named") == 1)).cast("int"), "multi": (compared & (F.col("named") > 1)).cast("int")}
    # Questions and competitors are brought together by one grouping, so that neither side can be broadcast.
    found = hits.select("bank_id", F.col("owner").alias("place"), F.lit(None).cast("string").alias("name"), *[c.alias(n) for n, c in counts.items()])
    both = found.unionByName(bank.rivals.select("bank_id", "place", "name", *[F.lit(0).alias(n) for n in counts]))
    keyed = both.groupBy("bank_id", "place").agg(F.collect_list("name").alias("names"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts])
    return keyed.select("bank_id", "place", F.explode("names").alias("name"), *counts)


def comparison_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    """Three solo comparisons from three on, and two others from five on, where there are three competitors."""
    compared = flags.where("question_type = 'branded' and funnel_intent = 'comparison'").groupBy("bank_id").agg(F.count("*").alias("comparisons"))
    cover = rival_coverage(bank, flags)
    per = cover.groupBy("bank_id").agg(F.count("*").alias("rivals"), F.sum("solo").alias("solos")).join(compared, "bank_id").where("rivals = 3 and comparisons >= 3")
    lonely = cover.where("solo < 1").join(per.select("bank_id"), "bank_id", "left_semi")
    return _find(lonely, "NO_SOLO_COMPARISON", None, F.col("name")).unionByName(
        _find(per.where("comparisons >= 5 and comparisons - solos < 2"), "FEW_OTHER_COMPARISONS")
    )


def audience_coverage(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, audience, generic_total, recommendation, comparison, decision, share) of each target audience."""
    aims = bank.config.select(
        "bank_id", F.explode(_texts("doc", "$.config.target_audiences")).alias("audience")
    ).withColumn("key", normalize_name(F.col("audience")))
    generic = flags.where("question_type = 'generic'").withColumn("key", normalize_name(F.col("audience_role")))
    n = lambda i: F.count_if(F.col("funnel_intent") == i).alias(i)
    names = ["generic_total", "recommendation", "comparison", "decision"]
    counts = generic.groupBy("bank_id", "key").agg(F.count("*").alias("generic_total"), n("recommendation"), n("comparison"), n("decision"))
    # A bank's labels as one map beside their total: the questions are read once for both.
    banks = counts.groupBy("bank_id").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct(*names)))).alias("counts"), F.sum("generic_total").alias("all"))
    joined = aims.join(banks, "bank_id", "left").withColumn("of", F.try_element_at("counts", F.col("key")))
    joined = joined.select("bank_id", "audience", *[F.col(f"of.{x}").alias(x) for x in names], "all").fillna(0, [*names, "all"])
    return joined.select("bank_id", "audience", *names, ratio(F.col("generic_total"), F.col("all")).alias("share"))


def style(flags: DataFrame) -> DataFrame:
    """A row for each bank: distinct labels, singletons, openers and promotional wording as counts and ratios."""
    dims = ("cluster", "scenario", "constraint", "audience_role", "opener")
    # Totals are labels too, so that questions are read and grouped once.
    totals = {"total": F.lit(True), "promotional": F.col("promotional"), "low_confidence": F.col("low_confidence")}
    each = {d: F.col(d) for d in dims} | {d: F.when(hit, "") for d, hit in totals.items()}
    labels = flags.select(
        "bank_id", "row_no", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), label.alias("label")) for d, label in each.items()])).alias("x")
    ).select("bank_id", "row_no", "x.*").where("label is not null")
    per = labels.groupBy("bank_id", "dim", "label").agg(F.count("*").alias("n"), F.min("row_no").alias("first"))
    of = lambda d: F.col("dim") == d
    rows = per.groupBy("bank_id").agg(
        *[F.sum(F.when(of(d), F.col("n")).otherwise(0)).alias(d) for d in totals],
        *[F.count_if(of(d)).alias(f"distinct_{d}") for d in ("audience_role", "scenario", "constraint")], *[
            F.count_if(of(d) & (F.col("n") == 1)).alias(f"single_{d}") for d in ("cluster", "scenario", "constraint")
        ],
        F.sum(F.when(of("opener") & F.col("label").isin(*fixed.COMMON_OPENERS), F.col("n")).otherwise(0)).alias("common_openers"),
        F.max_by(F.when(of("opener"), F.struct("label", "n")), F.when(of("opener"), F.struct(F.col("n"), -F.col("first")))).alias("top"),
    )
    rows = rows.withColumn("top_opener", F.col("top.label")).withColumn("top_opener_n", F.coalesce("top.n", F.lit(0))).drop("top")
    for name in STYLES:
        rows = rows.withColumn(f"{name}_ratio", ratio(F.col(name), F.col("total")))
    return rows


def style_codes(ratios: dict[str, Column], total: Column) -> Column:
    """(code, severity) of a batch that lacks variety, by its ratios; batches of less than ten rows have none."""
    rules = (
        ("PROMOTIONAL", ratios["promotional"] > fixed.MAX_PROMOTIONAL, F.lit(False)),
        ("SINGLE_CLUSTERS", ratios["single_cluster"] > fixed.MAX_CLUSTER, ratios["single_cluster"] > fixed.HIGH_CLUSTER),
        ("SINGLE_SCENARIOS", ratios["single_scenario"] >= fixed.MIN_METADATA, F.lit(False)),
        ("SINGLE_CONSTRAINTS", ratios["single_constraint"] >= fixed.MIN_METADATA, F.lit(False)),
        ("COMMON_OPENERS", ratios["common_openers"] > fixed.MAX_OPENERS, ratios["common_openers"] > fixed.HIGH_OPENERS),
        ("DOMINANT_OPENER", ratios["top_opener_n"] > fixed.MAX_ONE_OPENER, F.lit(False)),
        ("LOW_CONFIDENCE", ratios["low_confidence"] > fixed.MAX_PROMOTIONAL, F.lit(False)),
    )
    hits = [F.when((total >= fixed.MIN_BATCH) & hit, F.struct(F.lit(code).alias("code"), F.when(high, "high_risk").otherwise("warning").alias("severity"))) for code, hit, high in rules]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


#: Counts of a batch that become ratios.
STYLES = ("promotional", "low_confidence", "single_cluster", "single_scenario", "single_constraint", "common_openers", "top_opener_n")


def style_warnings(styles: DataFrame) -> DataFrame:
    """(bank_id, code, severity) of batches that lack variety."""
    codes = style_codes({n: F.col(f"{n}_ratio") for n in STYLES}, F.col("total"))
    return styles.select("bank_id", F.explode(codes).alias("x")).select("bank_id", "x.*")


def review_counts(bank: Bank, flags: DataFrame) -> DataFrame:
    """(bank_id, visible, commercial): complete questions that show their category, and questions, incomplete ones too, that were reviewed as commercial."""
    shown = visible(bank, flags).groupBy("bank_id").agg(F.count("*").alias("visible"))
    reviewed = bank.rows.groupBy("bank_id").agg(
        F.count_if(_true(F.try_variant_get(F.col("q"), "$.quality_checks.commercial_intent", "variant"))).alias("commercial")
    )
    both = bank.config.select("bank_id").join(shown, "bank_id", "left").join(reviewed, "bank_id", "left")
    return both.fillna(0, ["visible", "commercial"])


def _least(current: Column) -> Column:
    """Minima of different labels as a map: those given, else the default ones of banks that are large enough."""
    held = F.try_variant_get(F.col("doc"), "$.config.min_distinct_counts", "variant")
    absent = held.isNull() | (F.schema_of_variant(held) == "VOID")
    default = F.create_map(*[F.lit(x) for pair in fixed.MIN_DISTINCT.items() for x in pair])
    own = F.coalesce(F.try_variant_get(held, "$", "map<string,int>"), F.map_filter(default, lambda k, v: F.lit(False)))
    large = F.coalesce("expected_total", F.lit(fixed.QUOTA_TOTAL)) >= fixed.DISTINCT_FROM
    default = F.map_filter(default, lambda k, v: large)
    return F.when(absent, default).otherwise(F.map_filter(own, lambda k, v: ~(current & (k == "geo_intents"))))


def distinct_findings(bank: Bank, styles: DataFrame) -> DataFrame:
    """(bank_id, code, ...) of dimensions with too few labels; banks without a complete row have none.

    A minimum for anything but roles, scenarios and constraints is never met, unless it is zero.
    """
    rows = bank.config.join(styles, "bank_id", "left").select("bank_id", "distinct_audience_role", "distinct_scenario", "distinct_constraint", F.explode(_least(F.col("current"))).alias("k", "least"))
    actual = F.when(F.col("k") == "audience_roles", F.col("distinct_audience_role")).when(F.col("k") == "scenarios", F.col("distinct_scenario")).when(F.col("k") == "constraints", F.col("distinct_constraint"))
    return _find(rows.where(F.coalesce(actual, F.lit(0)) < F.col("least")), "FEW_DISTINCT", None, F.col("k"))


def intent_findings(bank: Bank, flags: DataFrame) -> DataFrame:
    """Current banks that lack one of the three intents."""
    intents = F.explode(F.array(*map(F.lit, ("recommendation", "comparison", "decision")))).alias("funnel_intent")
    wanted = bank.config.where("current").select("bank_id", intents)
    return _find(wanted.join(flags.select("bank_id", "funnel_intent"), ["bank_id", "funnel_intent"], "left_anti"), "NO_INTENT", None, F.col("funnel_intent"))


def rival_tiers(bank: Bank) -> DataFrame:
    """(bank_id, tier, n): formal competitors by known tier, of selections of three."""
    return bank.rivals.where(F.col("tier").isin("direct", "adjacent", "fallback")).groupBy("bank_id", "tier").agg(F.count("*").alias("n"))


def _expected_sentiment(topic: Column) -> Column:
    """The wording of a brand-sentiment question."""
    return F.concat(F.lit("Evaluate the "), F.col("category_label"), F.lit(" "), F.col("object_type"), F.lit(" "), F.col("brand"), F.lit(" on "), or_empty(topic))


def _config_warnings() -> Column:
    """Codes of what a configuration should have and may do without."""
    version = F.col("version")
    return F.filter(
        F.array(
            F.when(version == "", "LEGACY_WITHOUT_VERSION"), F.when(version.isin(*fixed.LEGACY_VERSIONS), "LEGACY_VERSION"),
            F.when(F.size(_strings(F.col("doc"), KINDS["excluded"])) == 0, "NO_EXCLUDED_CATEGORIES")
        ),
        lambda c: c.isNotNull()
    )


def warnings(bank: Bank, styles: DataFrame) -> DataFrame:
    """(bank_id, code, severity) of what is no fault: missing variety, old versions, no excluded categories."""
    codes = _config_warnings()
    return style_warnings(styles).unionByName(bank.config.select("bank_id", F.explode(codes).alias("code"), F.lit("warning").alias("severity")))


def findings(bank: Bank, flags: DataFrame | None = None) -> DataFrame:
    """All findings of all banks (U3). Every rule reads `flags`: hand over those of `row_flags`, kept, to compute them once."""
    flags = row_flags(bank) if flags is None else flags
    styles = style(flags)
    out = _find(bank.shapeless, "QUESTIONS_SHAPE").unionByName(config_findings(bank.config)).unionByName(row_findings(bank, flags))
    out = out.unionByName(comparison_findings(bank, flags)).unionByName(intent_findings(bank, flags)).unionByName(distinct_findings(bank, styles))
    out = out.unionByName(_find(duplicates(flags), "DUPLICATE", None, F.concat_ws(":", "what", "key"))).unionByName(
        _find(topic_coverage(bank, flags), "TOPIC_SENTIMENT", None, F.col("topic_id"))
    )
    out = out.unionByName(_find(quota_differences(flags, bank.quotas), "QUOTA", None, F.concat_ws(":", "dimension", "key")))
    return out.unionByName(_find(term_coverage(bank, flags).where("actual < minimum"), "TERM_COVERAGE", None, F.concat_ws(":", "concept", "measure")))


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """(run_id, alias_norm, owners): aliases that two objects of a run share."""
    return aliases.groupBy("run_id", "alias_norm").agg(F.countDistinct("object_id").alias("owners")).where("owners > 1")
