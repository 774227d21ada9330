"""All findings of question banks in one pass (U3): one reading, two shuffles, whatever the number of rules.

A bank's lists are packed into its row before its questions are laid out, so each rule of a question is a
column of the question's row. A question gives its findings, and the labels by which batches are counted.
Both are laid out once, counted by bank and label, and brought together by bank, where the rules of
batches are columns again. A bank is one document, which bounds what is brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import normalize_name, normalize_template, or_empty, ratio, strip
from . import bank
from .bank_config import config_codes

ENTRY = "array<struct<dim: string, label: string, detail: string>>"
NO_TEXT = "string"


def _null() -> Column:
    return F.lit(None).cast("string")


def _entry(dim: str | Column, label: Column | None = None, detail: Column | None = None) -> Column:
    dim = F.lit(dim) if isinstance(dim, str) else dim
    return F.struct(
        dim.cast("string").alias("dim"), (_null() if label is None else label.cast("string")).alias("label"), (_null() if detail is None else detail.cast("string")).alias("detail")
    )


def _if(condition: Column, entries: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), entries).otherwise(F.array().cast(ENTRY))


def _packed(raw: DataFrame) -> DataFrame:
    """A row for each bank: its columns, its lists as arrays, what is wrong with its configuration, and its questions."""
    docs = raw.select("bank_id", F.try_parse_json("body").alias("doc"))
    at = lambda path: F.try_variant_get(F.col("doc"), path, "string")
    version = strip(F.coalesce(F.nullif(at("$.schema_version"), F.lit("")), at("$.config.schema_version"), F.lit("")))
    asked = bank.asked("doc")
    docs = docs.select(
        "bank_id", "doc", version.alias("version"), (version == fixed.CURRENT_VERSION).alias("current"), asked.alias("asked"), F.size(asked).alias("questions"),
        strip(or_empty(at("$.config.brand_name"))).alias("brand"), strip(or_empty(at("$.config.category_label"))).alias("category_label"),
        strip(or_empty(at("$.config.brand_object_type"))).alias("object_type"), F.try_variant_get(F.col("doc"), "$.config.expected_total", "int").alias("expected_total"),
    )
    none = bank._topics()
    return docs.select(
        "bank_id", "current", "brand", "category_label", "object_type", F.col("asked").isNotNull().alias("listed"), "asked",
        F.when(F.col("current"), none).otherwise(F.slice(none, 1, 0)).alias("topics"), bank.named().alias("names"),
        F.transform(bank._formal(), lambda c: F.struct(c["place"].alias("place"), c["name"].alias("name"))).alias("rivals"), bank._category().alias("category"),
        F.coalesce(bank._term_specs(), F.array()).alias("terms"), bank._quotas(F.col("current")).alias("quotas"), F.map_entries(bank._least(F.col("current"))).alias("least"),
        config_codes().alias("config_codes"), bank._config_warnings().alias("warnings"),
    )


def _row_findings() -> Column:
    """Findings of a question as entries of the dimension `!`: its id as label, code and detail as detail."""
    text, now, whole = F.col("text"), F.col("current"), F.col("whole")
    of = lambda code, detail=None: F.struct(
        F.lit(code).alias("code"), F.col("question_id").alias("question_id"), (_null() if detail is None else detail.cast("string")).alias("detail")
    )
    one = lambda hit, code, detail=None: F.when(F.coalesce(hit, F.lit(False)), of(code, detail))
    named = F.col("named")
    spelt = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda n: n["name"]))), ",")
    rivals = F.filter(named, lambda n: n["kind"].isin("competitor", "formal"))
    hits = F.col("hits")
    shown = F.exists(hits, lambda c: c["kind"].isin("core_terms", "product_terms"))
    topic = F.col("topic")
    differs = normalize_template(text) != normalize_template(bank._expected_sentiment(F.try_element_at(topic, F.lit(1))))
    sentiment, generic, branded = F.col("is_sentiment"), F.col("question_type") == "generic", F.col("question_type") == "branded"
    single = [
        *[one(F.col(r), r.upper()) for r in bank.ROW_RULES], one(text == "", "EMPTY_QUESTION"), one(now & (F.col("intent_key") == ""), "EMPTY_INTENT_KEY"),
        *[one(F.size(n) > 0, code, F.array_join(n, ",")) for n, code in (("repeats", "REPEATS_FIELD"), ("failed_checks", "QUALITY_CHECKS"), ("retired", "RETIRED_FIELDS"))],
        one(now & (F.size(topic) == 0), "UNKNOWN_TOPIC", F.col("topic_id")), one(sentiment & differs, "SENTIMENT_TEMPLATE"),
        one(sentiment & ~F.coalesce(branded, F.lit(False)), "SENTIMENT_TYPE"),
        one(sentiment & ~F.coalesce(F.col("funnel_intent") == "decision", F.lit(False)), "SENTIMENT_INTENT"),
        one(generic & (F.size(named) > 0), "ENTITY_LEAK", spelt(named)), one(sentiment & (F.size(rivals) > 0), "SENTIMENT_COMPETITOR", spelt(rivals)),
        one(branded & (F.col("brand") != "") & ~F.exists(named, lambda n: n["kind"] == "brand"), "BRAND_MISSING"), one(now & ~shown, "CATEGORY_HIDDEN"),
    ]
    listed = F.concat(
        F.transform(F.filter(hits, lambda c: now & (c["kind"] == "placeholder_blacklist")), lambda c: of("PLACEHOLDER", c["term"])),
        F.transform(F.filter(hits, lambda c: (c["kind"] == "excluded") & ~F.col("boundary")), lambda c: of("CATEGORY_DRIFT", c["term"])),
        F.transform(F.filter("spec_hits", lambda s: s["acronym"] & ~s["expanded"] & ~s["context"]), lambda s: of("BARE_ACRONYM", s["spelt"])),
    )
    found = F.filter(F.array(*single), lambda x: x.isNotNull())
    lacking = F.filter(F.array(one(F.size("missing") > 0, "MISSING_FIELDS", F.array_join("missing", ","))), lambda x: x.isNotNull())
    all_ = F.concat(lacking, F.when(whole, F.concat(found, listed)).otherwise(F.slice(found, 1, 0)))
    return F.transform(all_, lambda x: _entry(F.concat(F.lit("!"), x["code"]), x["question_id"], x["detail"]))


def _row_labels() -> Column:
    """The labels by which a complete question is counted."""
    now = F.col("current")
    compared = (F.col("question_type") == "branded") & (F.col("funnel_intent") == "comparison")
    places = F.array_distinct(F.transform(F.filter("named", lambda n: n["kind"] == "formal"), lambda n: n["owner"]))
    plain = [
        _entry("total"), _entry("question_type", F.col("question_type")), _entry("funnel_intent", F.col("funnel_intent")),
        F.when(F.col("question_type").isin("generic", "branded"), _entry(F.concat(F.lit("cross."), "question_type"), F.col("funnel_intent"))),
        _entry("question_id", F.col("question_id")), _entry("question", F.col("norm")), F.when(now, _entry("intent_key", F.col("intent_key"))),
        F.when(F.col("is_sentiment"), _entry("topic", F.col("topic_id"))),
        *[_entry(d, F.col(d)) for d in ("audience_role", "scenario", "constraint", "cluster", "opener")],
        F.when(F.col("promotional"), _entry("promotional")), F.when(F.col("low_confidence"), _entry("low_confidence")),
        F.when(compared, _entry("compared")), F.when(compared & (F.size(places) == 1), _entry("solo", F.try_element_at(places, F.lit(1)))),
    ]
    measures = lambda s: F.filter(
        F.array(
            F.when(s["hit"], "total"), F.when(s["hit"] & (F.col("question_type") == "generic"), "generic"), F.when(s["hit"] & (F.col("question_type") == "branded"), "branded"),
            F.when(s["expanded"], "expanded"), F.when(s["acronym"], "acronym")
        ), lambda m: m.isNotNull()
    )
    terms = F.flatten(F.transform("spec_hits", lambda s: F.transform(measures(s), lambda m: _entry("term", F.concat(s["concept"], F.lit(":"), m)))))
    # A total has no label; a missing one counts nothing.
    held = F.filter(F.array(*plain), lambda x: x.isNotNull() & (x["label"].isNotNull() | x["dim"].isin("total", "promotional", "low_confidence", "compared")))
    return _if(F.col("whole"), F.concat(held, terms))


def _batch_findings() -> Column:
    """(code, detail) of a bank from its lists and the counts of its labels."""
    entries, pack, now = F.col("entries"), F.col("pack"), F.col("pack.current")
    found = lambda code, detail=None: F.struct(F.lit(code).alias("code"), (_null() if detail is None else detail).alias("detail"))

    def count(dim: str | Column, label: Column | None = None) -> Column:
        key = F.concat_ws("\x01", F.lit(dim) if isinstance(dim, str) else dim, *([] if label is None else [label.cast("string")]))
        return F.coalesce(F.try_element_at("counts", key), F.lit(0))

    of = lambda *dims: F.filter(entries, lambda e: e["dim"].isin(*dims))
    twice = F.filter(of("question_id", "question", "intent_key"), lambda e: (e["n"] > 1) & (e["label"] != ""))
    topics = F.filter(F.when(now, pack["topics"]), lambda t: count("topic", t["topic_id"]) != 1)
    short = F.filter(pack["quotas"], lambda q: q["key"].isNotNull() & (count(q["dimension"], q["key"]) != q["expected"]))
    # Counted, and without a quota in a dimension that is compared.
    compared = F.transform(pack["quotas"], lambda q: q["dimension"])
    known = F.transform(F.filter(pack["quotas"], lambda q: q["key"].isNotNull()), lambda q: F.concat_ws("\x01", q["dimension"], q["key"]))
    beyond = F.filter(entries, lambda e: F.array_contains(compared, e["dim"]) & e["label"].isNotNull() & ~F.array_contains(known, F.concat_ws("\x01", e["dim"], e["label"])))
    intents = F.filter(F.array(*map(F.lit, fixed.COMMERCIAL_INTENTS)), lambda i: now & (count("funnel_intent", i) == 0))
    measures = [("total", "min_total"), ("generic", "min_generic"), ("branded", "min_branded"), ("expanded", "min_expanded"), ("acronym", "min_acronym")]
    terms = F.flatten(F.transform(pack["terms"], lambda s: F.filter(F.array(*[
        F.when(count("term", F.concat(s["concept"], F.lit(f":{m}"))) < s[least], F.concat(s["concept"], F.lit(f":{m}"))) for m, least in measures
    ]), lambda x: x.isNotNull())))
    spread = lambda k: F.when(k == "audience_roles", F.size(of("audience_role"))).when(k == "scenarios", F.size(of("scenario"))).when(
        k == "constraints", F.size(of("constraint"))
    ).otherwise(0)
    few = F.filter(pack["least"], lambda m: spread(m["key"]) < m["value"])
    three = (F.size(pack["rivals"]) == 3) & (count("compared") >= 3)
    solo = F.aggregate(of("solo"), F.lit(0).cast("long"), lambda a, e: a + e["n"])
    lonely = F.filter(pack["rivals"], lambda r: three & (count("solo", r["place"]) == 0))
    others = F.filter(F.array(F.when(three & (count("compared") >= 5) & (count("compared") - solo < 2), found("FEW_OTHER_COMPARISONS"))), lambda x: x.isNotNull())
    return F.concat(
        F.transform(pack["config_codes"], lambda x: F.struct(x["code"].alias("code"), F.nullif(x["detail"], F.lit("")).alias("detail"))),
        F.transform(twice, lambda e: found("DUPLICATE", F.concat_ws(":", e["dim"], e["label"]))),
        F.coalesce(F.transform(topics, lambda t: found("TOPIC_SENTIMENT", t["topic_id"])), F.array().cast("array<struct<code: string, detail: string>>")),
        F.transform(short, lambda q: found("QUOTA", F.concat_ws(":", q["dimension"], q["key"]))),
        F.transform(beyond, lambda e: found("QUOTA", F.concat_ws(":", e["dim"], e["label"]))),
        F.transform(intents, lambda i: found("NO_INTENT", i)), F.transform(terms, lambda t: found("TERM_COVERAGE", t)),
        F.transform(few, lambda m: found("FEW_DISTINCT", m["key"])), F.transform(lonely, lambda r: found("NO_SOLO_COMPARISON", r["name"])), others,
    )


def _batch_styles() -> Column:
    """(code, severity) of a bank's warnings."""
    entries = F.col("entries")
    of = lambda dim: F.filter(entries, lambda e: e["dim"] == dim)
    total = F.coalesce(F.try_element_at("counts", F.lit("total")), F.lit(0))
    counts = {n: F.coalesce(F.try_element_at("counts", F.lit(n)), F.lit(0)) for n in ("promotional", "low_confidence")}
    counts |= {f"single_{d}": F.size(F.filter(of(d), lambda e: e["n"] == 1)) for d in ("cluster", "scenario", "constraint")}
    openers = of("opener")
    counts["common_openers"] = F.aggregate(
        F.filter(openers, lambda e: e["label"].isin(*fixed.COMMON_OPENERS)), F.lit(0).cast("long"), lambda a, e: a + e["n"]
    )
    counts["top_opener_n"] = F.coalesce(F.array_max(F.transform(openers, lambda e: e["n"])), F.lit(0))
    own = F.transform("pack.warnings", lambda c: F.struct(c.alias("code"), F.lit("warning").alias("severity")))
    return F.concat(bank.style_codes({n: ratio(c, total) for n, c in counts.items()}, total), own)


def _questions(docs: DataFrame, *more: str | Column) -> DataFrame:
    """A row for each question of `_packed` with its flags and the names, terms and topics found in it, one without a place for a bank without questions."""
    rows = docs.select(
        "bank_id", "current", "brand", "category_label", "object_type", "topics", "names", "category", "terms", *more, F.posexplode_outer("asked").alias("pos", "x")
    ).select("*", "x.*").drop("x").withColumn("row_no", F.col("pos") + 1)
    rows = bank.with_flags(bank.with_missing(rows))
    text = F.concat(F.lit(" "), "norm", F.lit(" "))
    shows = lambda name: (normalize_name(name) != "") & F.contains(text, F.concat(F.lit(" "), normalize_name(name), F.lit(" ")))
    any_of = lambda c: F.exists(c, shows)
    specs = F.transform(
        "terms", lambda s: F.struct(
            s["concept"].alias("concept"), s["acronym"].alias("spelt"), any_of(s["terms"]).alias("hit"), shows(s["expanded_form"]).alias("expanded"),
            shows(s["acronym"]).alias("acronym"), any_of(s["context_terms"]).alias("context")
        )
    )
    topic = F.transform(F.filter("topics", lambda t: t["topic_id"] == F.col("topic_id")), lambda t: t["topic"])
    return rows.withColumns({
        "whole": F.col("pos").isNotNull() & ~F.col("fatal"), "spec_hits": specs, "named": F.filter("names", lambda n: F.rlike("text", n["pattern"])),
        "hits": F.filter("category", lambda c: shows(c["term"])), "topic": topic
    })


def row_findings(raw: DataFrame) -> DataFrame:
    """(bank_id, code, question_id, detail) of the questions of `raw(bank_id, body)`, each by itself: nothing is joined or shuffled."""
    rows = _questions(_packed(raw))
    found = rows.select("bank_id", F.explode(_if(F.col("pos").isNotNull(), _row_findings())).alias("x"))
    return found.select("bank_id", F.substring("x.dim", 2, 99).alias("code"), F.col("x.label").alias("question_id"), "x.detail")


def all_findings(raw: DataFrame) -> DataFrame:
    """(bank_id, severity, code, question_id, detail) of the banks of `raw(bank_id, body)`; severity is error, warning or high_risk.

    A bank whose questions are no list has that one finding; one without questions has those of its configuration
    and batch. A bank's id stands for one document; documents that share one are taken together.
    """
    docs = _packed(raw)
    pack = F.struct("current", "listed", "topics", "rivals", "terms", "quotas", "least", "config_codes", "warnings")
    rows = _questions(docs, pack.alias("pack"))
    # The first question of a bank, or the row of one without, brings its lists along.
    first = F.coalesce(F.col("pos") == 0, F.lit(True))
    entries = F.concat(_if(first, F.array(_entry("?"))), _if(F.col("pos").isNotNull(), _row_findings()), _row_labels())
    laid = rows.select("bank_id", F.when(first, F.col("pack")).alias("pack"), F.explode(entries).alias("e"))
    laid = laid.select("bank_id", "e.*", F.when(F.col("e.dim") == "?", F.col("pack")).alias("pack"))
    counted = laid.groupBy("bank_id", "dim", "label", "detail").agg(F.count("*").alias("n"), F.first("pack", ignorenulls=True).alias("pack"))
    banks = counted.groupBy("bank_id").agg(F.collect_list(F.struct("dim", "label", "detail", "n")).alias("every"), F.first("pack", ignorenulls=True).alias("pack"))
    banks = banks.withColumn("entries", F.filter("every", lambda e: ~F.substring(e["dim"], 1, 1).isin("!", "?")))
    banks = banks.withColumn("counts", F.map_from_entries(F.transform("entries", lambda e: F.struct(F.concat_ws("\x01", e["dim"], e["label"]), e["n"]))))
    error = lambda code, question, detail: F.struct(F.lit("error").alias("severity"), code.alias("code"), question.alias("question_id"), detail.alias("detail"))
    of_rows = F.flatten(
        F.transform(
            F.filter("every", lambda e: F.substring(e["dim"], 1, 1) == "!"),
            lambda e: F.array_repeat(error(F.substring(e["dim"], 2, 99), e["label"], e["detail"]), e["n"].cast("int"))
        )
    )
    of_batch = F.transform(_batch_findings(), lambda x: error(x["code"], _null(), x["detail"]))
    of_style = F.transform(_batch_styles(), lambda x: F.struct(x["severity"].alias("severity"), x["code"].alias("code"), _null().alias("question_id"), _null().alias("detail")))
    shape = F.array(error(F.lit("QUESTIONS_SHAPE"), _null(), _null()))
    found = F.when(F.col("pack.listed"), F.concat(of_rows, of_batch, of_style)).otherwise(shape)
    return banks.select("bank_id", F.explode(found).alias("x")).select("bank_id", "x.*")
