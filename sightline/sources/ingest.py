"""Raw JSON into tables.

A raw table has one JSON document a row: (run_id, body string). Bodies are read as VARIANT, so that a
malformed element spoils itself only. All aliases of field names are coalesced here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions.text import casefold, normalize_text, or_empty, strip


def parsed(raw: DataFrame) -> DataFrame:
    """(run_id, doc variant, offset); unparsable bodies have a null document.

    `offset` is that of `raw` or 0: the place in its list of the first element that a document holds.
    """
    offset = F.col("offset") if "offset" in raw.columns else F.lit(0)
    return raw.select("run_id", F.try_parse_json("body").alias("doc"), offset.cast("int").alias("offset"))


def text_at(v: str | Column, path: str) -> Column:
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, "string")


def _int_at(v: str, path: str) -> Column:
    return F.try_variant_get(F.col(v), path, "int")


def _array_at(v: str, path: str) -> Column:
    """Elements of an array field; null where the field is no array."""
    return F.try_variant_get(F.col(v), path, "array<variant>")


def _is_true(v: Column) -> Column:
    """Strictly boolean true: text that spells true is not."""
    return F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), F.lit(False))


def _is_false(v: Column) -> Column:
    return F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean"), F.lit(False))


def validity(answer: Column) -> Column:
    """Null for a usable answer, else the code of the first signature that it has."""
    text = strip(or_empty(answer))
    code = F.when(text == "", F.lit("EMPTY_ANSWER"))
    for name, pattern in fixed.INVALID_SIGNATURES:
        code = code.when(text.rlike(pattern), F.lit(name))
    return code


def with_status(samples: DataFrame) -> DataFrame:
    """Add status, analysis_eligible, error_code from (raw_status, ok, has_result, result_failed, answer_text)."""
    bad = validity(F.col("answer_text"))
    code = (
        F.when(F.col("raw_status") == "pending", "PENDING")
        .when((F.col("raw_status") == "failed") | ~F.col("ok"), "SOURCE_FAILED")
        .when(~F.col("has_result"), "MISSING_RESULT")
        .when(F.col("result_failed"), "SOURCE_FAILED")
        .otherwise(bad)
    )
    status = F.when(F.col("error_code").isNull(), "success").when(F.col("error_code") == "PENDING", "pending").when(
        F.col("error_code").isin("SOURCE_FAILED", "MISSING_RESULT"), "failed"
    ).otherwise("invalid")
    return samples.withColumn("error_code", code).withColumn("status", status).withColumn("analysis_eligible", F.col("error_code").isNull())


def batch_samples(docs: DataFrame) -> DataFrame:
    """Samples of batch documents: one row for each element of `samples`."""
    rows = docs.where(F.startswith(F.schema_of_variant(F.variant_get("doc", "$.samples", "variant")), F.lit("ARRAY")))
    s = rows.select("run_id", "offset", F.posexplode(_array_at("doc", "$.samples")).alias("pos", "s")).withColumn("sample_pos", F.col("pos") + F.col("offset"))
    result = F.try_variant_get(F.col("s"), "$.result", "variant")
    has = F.coalesce(F.startswith(F.schema_of_variant(result), F.lit("OBJECT")), F.lit(False))
    sample = text_at("s", "$.sample_id")
    question = F.coalesce(text_at("s", "$.question_id"), F.nullif(F.regexp_extract(or_empty(sample), r"^(.+)-r\d+$", 1), F.lit("")))
    return s.select(
        "run_id", "sample_pos", sample.alias("sample_id"), question.alias("question_id"), text_at("s", "$.question").alias("question_text"),
        _int_at("s", "$.question_index").alias("question_index"), F.coalesce(F.nullif(_int_at("s", "$.repeat_index"), F.lit(0)), F.lit(1)).alias("repeat_index"),
        F.lower(or_empty(text_at("s", "$.status"))).alias("raw_status"), _is_true(F.try_variant_get(F.col("s"), "$.ok", "variant")).alias("ok"),
        has.alias("has_result"), (has & _is_false(F.try_variant_get(result, "$.ok", "variant"))).alias("result_failed"),
        F.when(has, or_empty(F.coalesce(text_at("s", "$.result.answer.text"), text_at("s", "$.result.answer")))).alias("answer_text"),
        F.try_variant_get(F.col("s"), "$.result.references", "variant").alias("references"), F.lit("batch").alias("source_shape"),
    )


def collection_results(docs: DataFrame) -> DataFrame:
    """Samples of raw collections: a list, `{results}` or one object, each with an optional `manifest` envelope."""
    shape = F.schema_of_variant("doc")
    rows = docs.where(~F.coalesce(F.startswith(F.schema_of_variant(F.try_variant_get(F.col("doc"), "$.samples", "variant")), F.lit("ARRAY")), F.lit(False)))
    items = F.when(F.startswith(shape, F.lit("ARRAY")), _array_at("doc", "$")).otherwise(F.coalesce(_array_at("doc", "$.results"), F.array("doc")))
    name = F.when(F.startswith(shape, F.lit("ARRAY")), "list").when(_array_at("doc", "$.results").isNotNull(), "results").otherwise("object")
    r = rows.select("run_id", "offset", name.alias("source_shape"), F.posexplode(items).alias("pos", "s")).withColumn("sample_pos", F.col("pos") + F.col("offset"))

    def either(path: str) -> Column:
        return F.coalesce(text_at("s", f"$.manifest.{path}"), text_at("s", f"$.{path}"))

    failed = _is_false(F.try_variant_get(F.col("s"), "$.ok", "variant"))
    return r.select(
        "run_id", "sample_pos", either("sample_id").alias("sample_id"), either("question_id").alias("question_id"), either("question").alias("question_text"),
        F.lit(None).cast("int").alias("question_index"), F.coalesce(either("repeat_index").try_cast("int"), F.lit(1)).alias("repeat_index"),
        F.lower(or_empty(either("status"))).alias("raw_status"), (~failed).alias("ok"), F.lit(True).alias("has_result"), failed.alias("result_failed"),
        or_empty(
            F.coalesce(text_at("s", "$.answer.text"), text_at("s", "$.answer"))
        ).alias("answer_text"), F.try_variant_get(F.col("s"), "$.references", "variant").alias("references"), "source_shape",
    )


def import_crawl(raw: DataFrame, questions: DataFrame) -> DataFrame:
    """All samples of both shapes with status, matched to questions, and pending rows for what is missing.

    `questions(run_id, question_id, question_text[, sequence])`. A sample matches by case-folded id, else by
    normalised text where exactly one question has it; `question_match` is null for neither. A sample without a
    question index, or with zero, has the sequence of its question.
    """
    docs = parsed(raw)
    samples = with_status(batch_samples(docs).unionByName(collection_results(docs)))
    sequence = F.col("sequence").cast("int") if "sequence" in questions.columns else F.lit(None).cast("int")
    questions = questions.withColumn("sequence", sequence)
    asked = questions.select(
        "run_id", "sequence", F.col("question_id").alias("known_id"), casefold(F.col("question_id")).alias("id_key"),
        normalize_text(F.col("question_text")).alias("text_key")
    )
    by_id = asked.select("run_id", "id_key", F.col("known_id").alias("by_id"), F.col("text_key").alias("known_text"), F.col("sequence").alias("id_sequence"))
    by_text = asked.where("text_key != ''").groupBy("run_id", "text_key").agg(
        F.min("known_id").alias("by_text"), F.count("*").alias("n"), F.min("sequence").alias("text_sequence")
    ).where("n = 1").drop("n")
    keyed = samples.withColumn("id_key", casefold(F.col("question_id"))).withColumn("text_key", normalize_text(F.col("question_text")))
    matched = keyed.join(by_id, ["run_id", "id_key"], "left").join(by_text, ["run_id", "text_key"], "left")
    found = matched.select(
        *[c for c in samples.columns if c not in ("references", "question_index")], "references", F.coalesce("by_id", "by_text").alias("question_match"),
        F.coalesce(F.nullif("question_index", F.lit(0)), "id_sequence", "text_sequence").alias("question_index"),
        (F.col("by_id").isNotNull() & (F.col("text_key") != "") & (F.col("text_key") != F.col("known_text"))).alias("text_differs"),
    )
    return found.unionByName(_missing(docs, found, questions), allowMissingColumns=True)


def _missing(docs: DataFrame, samples: DataFrame, questions: DataFrame) -> DataFrame:
    """Pending rows: planned samples that did not come (J3), and questions without any sample or plan."""
    plan = docs.select("run_id", F.explode(_array_at("doc", "$.plan")).alias("p")).select(
        "run_id", text_at("p", "$.sample_id").alias("sample_id"), text_at("p", "$.question_id").alias("question_match"),
        F.coalesce(F.nullif(_int_at("p", "$.repeat_index"), F.lit(0)), F.lit(1)).alias("repeat_index"),
        F.nullif(_int_at("p", "$.question_index"), F.lit(0)).alias("question_index")
    )
    keyed = questions.select("run_id", casefold(F.col("question_id")).alias("key"), "sequence")
    plan = plan.withColumn("key", casefold(F.col("question_match"))).join(keyed, ["run_id", "key"], "left")
    plan = plan.withColumn("question_index", F.coalesce("question_index", "sequence")).drop("key", "sequence")
    late = plan.join(samples.select("run_id", "sample_id"), ["run_id", "sample_id"], "left_anti")
    seen = samples.select("run_id", casefold(F.col("question_match")).alias("key")).unionByName(
        late.select("run_id", casefold(F.col("question_match")).alias("key"))
    )
    silent = questions.withColumn("key", casefold(F.col("question_id"))).join(seen, ["run_id", "key"], "left_anti").select(
        "run_id", F.concat("question_id", F.lit("-r01")).alias("sample_id"), F.col("question_id").alias("question_match"), F.lit(1).alias("repeat_index"),
        F.col("sequence").alias("question_index")
    )
    return late.unionByName(silent).withColumn("status", F.lit("pending")).withColumn("error_code", F.lit("PENDING")).withColumn("analysis_eligible", F.lit(False))


def crawl_findings(samples: DataFrame) -> DataFrame:
    """(run_id, code, sample_id): unmatched questions, differing texts, repeated sample ids."""
    known = samples.where("status != 'pending'")
    one = lambda rows, code: rows.select("run_id", F.lit(code).alias("code"), "sample_id")
    twice = samples.groupBy("run_id", "sample_id").count().where("count > 1")
    return one(known.where("question_match is null"), "UNKNOWN_QUESTION").unionByName(one(known.where("text_differs"), "QUESTION_TEXT_MISMATCH")).unionByName(one(twice, "DUPLICATE_SAMPLE"))


def _references(v: Column) -> tuple[Column, Column]:
    """(elements, malformed) of a reference block: items that hold nothing are an empty list, others that are no list are malformed."""
    items = F.try_variant_get(v, "$.items", "variant")
    listed = F.coalesce(F.startswith(F.schema_of_variant(items), F.lit("ARRAY")), F.lit(False))
    nothing = F.array().cast("array<variant>")
    return F.when(listed, F.try_variant_get(v, "$.items", "array<variant>")).otherwise(nothing), F.coalesce(_holds(items) & ~listed, F.lit(False))


def _holds(v: Column) -> Column:
    """Whether a value is there and is no empty text, list or object, false or zero."""
    return v.isNotNull() & ~F.to_json(v).isin('""', "[]", "{}", "null", "false", "0", "0.0")


def reference_findings(samples: DataFrame) -> DataFrame:
    """(run_id, code, sample_id) of malformed reference lists, for ineligible samples too.

    A declared count is compared with the elements of the list, of which there are none where it is malformed or absent.
    """
    items, malformed = _references(F.col("references"))
    count = F.try_variant_get(F.col("references"), "$.count", "variant")
    # A count of true or false is one or zero.
    number = F.when(F.schema_of_variant(count) == "BIGINT", F.try_variant_get(count, "$", "long")).when(
        F.schema_of_variant(count) == "BOOLEAN", F.try_variant_get(count, "$", "boolean").cast("long")
    )
    odd = F.filter(items, lambda i: ~F.startswith(F.schema_of_variant(i), F.lit("OBJECT")))
    codes = F.concat(
        F.filter(
            F.array(F.when(malformed, "INVALID_REFERENCE_ITEMS"), F.when(number != F.size(items), "REFERENCE_COUNT_MISMATCH")), lambda c: c.isNotNull()
        ), F.transform(odd, lambda i: F.lit("INVALID_REFERENCE_ITEM"))
    )
    return samples.where("references is not null").select("run_id", F.explode(codes).alias("code"), "sample_id")


def body_urls(text: Column) -> Column:
    """URLs written in a text, without stops at their ends."""
    return F.transform(F.regexp_extract_all(or_empty(text), F.lit(fixed.BODY_URL), F.lit(0)), lambda u: F.regexp_replace(u, "[.,;:]+$", ""))


def citations(samples: DataFrame) -> DataFrame:
    """Citations of eligible samples: objects of `references.items`, then URLs in the answer that those do not name.

    Other elements are skipped, their places in `source_order` kept; a link's is the number of citations kept
    before it plus one. Numbered in each sample as `C-{sample}-{nnn}`. Both lists lie in the sample's row, so
    nothing is joined or shuffled.
    """
    items, _ = _references(F.col("references"))
    text = lambda i, *names: F.coalesce(*[F.nullif(text_at(i, f"$.{n}"), F.lit("")) for n in names])

    def entry(source: str, order: Column, url: Column, item: Column | None) -> Column:
        own = lambda *names: F.lit(None).cast("string") if item is None else text(item, *names)
        return F.struct(
            F.lit(source).alias("citation_source"), order.cast("int").alias("source_order"), url.alias("raw_url"), own("source", "name").alias("source_name"),
            own("domain").alias("domain_hint"), own("title").alias("title"), own("date").alias("date"), own("summary").alias("summary")
        )

    url_of = lambda i: F.nullif(strip(or_empty(text(i, "url", "link", "href"))), F.lit(""))
    placed = F.filter(F.transform(items, lambda i, k: F.struct(i.alias("item"), k.alias("k"))), lambda x: F.startswith(F.schema_of_variant(x["item"]), F.lit("OBJECT")))
    platform = F.transform(placed, lambda x: entry("platform", x["k"] + 1, url_of(x["item"]), x["item"]))
    rows = samples.where("analysis_eligible").select("run_id", "sample_id", "answer_text", platform.alias("platform"))
    known = F.coalesce(F.transform("platform", lambda p: p["raw_url"]), F.array().cast("array<string>"))
    fresh = F.filter(body_urls(F.col("answer_text")), lambda u: ~F.coalesce(F.array_contains(F.filter(known, lambda k: k.isNotNull()), u), F.lit(False)))
    links = F.transform(fresh, lambda u, k: entry("body_link", F.size("platform") + k + 1, u, None))
    both = rows.select("run_id", "sample_id", F.posexplode(F.concat("platform", links)).alias("pos", "c"))
    return both.select(
        "run_id", "sample_id", "c.*", (F.col("pos") + 1).alias("citation_no"), F.format_string("C-%s-%03d", "sample_id", F.col("pos") + 1).alias("citation_id")
    )


def _first(v: str, *names: str) -> Column:
    """The first of several fields that is not blank."""
    return F.coalesce(*[F.nullif(strip(or_empty(text_at(v, f"$.{n}"))), F.lit("")) for n in names])


def import_questions(raw: DataFrame) -> DataFrame:
    """Questions of question banks, aliases of field names coalesced, labels canonical.

    A missing id is `q01`, `q02`.. by place. Elements that are no objects stay, with `is_object` false. Unknown
    labels are null beside what was claimed; `operators.imports.question_findings` reports them.
    """
    docs = parsed(raw)
    items = F.coalesce(_array_at("doc", "$.questions"), _array_at("doc", "$"))
    q = docs.select("run_id", "offset", F.posexplode(items).alias("pos", "q")).withColumn("place", F.col("pos") + F.col("offset") + 1)

    def label(value: Column, labels: dict) -> Column:
        keys = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        return F.try_element_at(keys, value)

    number = lambda name: F.nullif(_first("q", name).try_cast("int"), F.lit(0))  # noqa: E731 - zero counts as absent
    type_, intent = _first("q", "question_type", "type"), _first("q", "funnel_intent", "intent", "purchase_intent")
    return q.select(
        "run_id", "place", F.coalesce(_first("q", "question_id", "id"), F.format_string("q%02d", "place")).alias("question_id"),
        F.coalesce(number("generation_sequence"), number("index"), F.col("place")).alias("sequence"),
        _first(
            "q", "monitoring_prompt", "user_question", "question_text", "question", "standalone_rewrite"
        ).alias("question_text"), _first("q", "question_zh").alias("question_zh"),
        type_.alias("claimed_type"), intent.alias("claimed_intent"), label(type_, fixed.TYPE_LABELS).alias("question_type"),
        label(intent, fixed.INTENT_LABELS).alias("funnel_intent"),
        F.coalesce(intent.isin(*fixed.LEGACY_INTENTS), F.lit(False)).alias("migrated"), F.coalesce(
            F.startswith(F.schema_of_variant("q"), F.lit("OBJECT")), F.lit(False)
        ).alias("is_object"),
    )


def _listed(v: Column) -> Column:
    """A list as its elements, a single value as a list of one, nothing as an empty list."""
    kind = F.schema_of_variant(v)
    some = F.when(v.isNotNull() & (kind != "VOID") & ~((kind == "STRING") & (F.try_variant_get(v, "$", "string") == "")), F.array(v))
    return F.coalesce(F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")), some, F.array().cast("array<variant>"))


def _given(v: str, *names: str) -> Column:
    """The first of several fields of a document that holds anything: no empty text, list or object."""
    at = [F.try_variant_get(F.col(v), f"$.{n}", "variant") for n in names]
    empty = F.array(*map(F.lit, ('""', "[]", "{}", "null", "false", "0")))
    return F.coalesce(*[F.when(x.isNotNull() & ~F.array_contains(empty, F.to_json(x)), x) for x in at])


def _alias_of(v: Column) -> Column:
    """An alias as text, or as an object that names it and does not deny it."""
    named = F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{n}", "string"), F.lit("")) for n in ("raw_alias", "alias", "name")])
    is_object = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    return F.when(is_object, F.when(~_is_false(F.try_variant_get(v, "$.confirmed", "variant")), named)).otherwise(F.try_variant_get(v, "$", "string"))


def import_objects(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(objects, aliases, domains) of run configurations: the brand is `target`, competitors are numbered.

    A configuration may hold a `brand` object or its fields at the top, a list of competitors or a single one, as
    objects or plain names. Lists may be single values. Objects without a name have a null one.
    """
    docs = parsed(raw)
    no_text = F.lit(None).cast("string")
    brand = _given("doc", "brand")
    named = F.when(F.schema_of_variant(brand) == "STRING", F.try_variant_get(brand, "$", "string"))
    target = docs.select(
        "run_id", F.lit(0).alias("display_order"), F.coalesce(
            brand, F.when(_first("doc", "brand_name", "customer_name").isNotNull(), F.try_parse_json(F.lit("{}")))
        ).alias("o"), F.when(brand.isNull(), _first("doc", "brand_name", "customer_name")).otherwise(named).alias("flat_name"),
        F.when(brand.isNull(), _given("doc", "brand_aliases", "aliases")).alias("flat_aliases"), F.when(
            brand.isNull(), _given("doc", "brand_domain", "official_domain")
        ).alias("flat_domain"), F.when(brand.isNull(), _first("doc", "object_scope")).alias("flat_scope"),
    )
    rivals = docs.select("run_id", F.posexplode(_listed(_given("doc", "competitors", "comps_list"))).alias("pos", "o"))
    nothing = F.lit(None).cast("variant")
    plain = F.when(F.schema_of_variant("o") == "STRING", F.try_variant_get(F.col("o"), "$", "string"))
    rivals = rivals.select(
        "run_id", (F.col("pos") + 1).alias("display_order"), "o", plain.alias("flat_name"), nothing.alias("flat_aliases"), nothing.alias("flat_domain"),
        no_text.alias("flat_scope")
    )
    both = target.unionByName(rivals)
    is_target = F.col("display_order") == 0
    objects = both.select(
        "run_id", F.when(is_target, "target").otherwise(F.format_string("competitor-%02d", "display_order")).alias("object_id"),
        F.when(is_target, "target").otherwise("competitor").alias("role"),
        "display_order", F.coalesce(
            F.nullif(strip(or_empty(F.col("flat_name"))), F.lit("")), _first("o", "name", "canonical_name", "brand_name")
        ).alias("canonical_name"), F.coalesce("flat_scope", _first("o", "object_scope"), F.lit("brand")).alias("object_scope"),
        _listed(F.coalesce("flat_aliases", _given("o", "aliases", "confirmed_aliases"))).alias("listed"), _listed(
            F.coalesce("flat_domain", _given("o", "official_domains", "official_domain", "domain", "brand_domain"))
        ).alias("hosts"),
    )
    from ..functions.text import normalize_alias
    from ..functions.urls import normalize_host

    aliases = objects.select(
        "run_id", "object_id", F.posexplode(F.concat(F.array("canonical_name"), F.transform("listed", _alias_of))).alias("pos", "alias")
    ).withColumn("alias", strip(or_empty(F.col("alias")))).withColumn("alias_norm", normalize_alias(F.col("alias"))).where("alias_norm != ''")
    first = Window.partitionBy("run_id", "object_id", "alias_norm").orderBy("pos")
    aliases = aliases.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    names = F.transform("hosts", lambda h: F.try_variant_get(h, "$", "string"))
    domains = objects.select("run_id", "object_id", "role", "display_order", F.posexplode(names).alias("domain_pos", "d")).select(
        "run_id", "object_id", "role", "display_order", normalize_host(F.col("d")).alias("domain"), "domain_pos"
    ).where("domain is not null")
    return objects.drop("listed", "hosts"), aliases, domains


def import_runs(raw: DataFrame) -> DataFrame:
    """(run_id, topic, topics, market, language, platform, quota_total, quota_generic, quota_branded, sentiment_threshold, sample_policy) of run configurations.

    Missing values have their defaults. `topics` counts a list of topics, null without one. Without any quotas
    those of a standard run hold; a total that is missing is the sum of its types.
    """
    docs = parsed(raw)
    folded = lambda default, *names: casefold(strip(F.coalesce(_first("doc", *names), F.lit(default))))
    quotas = _given("doc", "quotas")
    count = lambda *paths: F.coalesce(*[F.try_variant_get(quotas, f"$.{p}", "int") for p in paths], F.lit(0))
    generic, branded = count("question_type.generic"), count("question_type.branded", "question_type.brand")
    total = F.coalesce(F.nullif(count("total"), F.lit(0)), count("expected_total"))
    return docs.select(
        "run_id", or_empty(_first("doc", "topic")).alias("topic"), F.size(_array_at("doc", "$.topics")).alias("topics"),
        folded("US", "market", "target_market").alias("market"), folded("en", "language").alias("language"), folded("chatgpt", "platform").alias("platform"),
        F.when(quotas.isNull(), fixed.QUOTA_TOTAL).when(total <= 0, generic + branded).otherwise(total).alias("quota_total"),
        F.when(quotas.isNull(), fixed.QUOTA_GENERIC).otherwise(generic).alias("quota_generic"),
        F.when(quotas.isNull(), fixed.QUOTA_BRANDED).otherwise(branded).alias("quota_branded"),
        F.coalesce(
            F.try_variant_get(F.col("doc"), "$.sentiment_confidence_threshold", "double"), F.lit(fixed.THRESHOLD)
        ).alias("sentiment_threshold"), F.coalesce(_first("doc", "sample_policy"), F.lit(fixed.SAMPLE_POLICY)).alias("sample_policy"),
    ).withColumn("topics", F.when(F.col("topics") >= 0, F.col("topics")))


SECTIONS = ("overview", "competitor", "citation", "brand_expression", "category_actions", "question_details")


def payload_sections(raw: DataFrame) -> DataFrame:
    """(run_id, section, body variant): sections as JSON or as a string that holds JSON."""
    docs = parsed(raw)
    rows = docs.select(
        "run_id",
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("section"), F.try_variant_get(F.col("doc"), f"$.{s}", "variant").alias("body")) for s in SECTIONS])
        ).alias("x")
    ).select("run_id", "x.*")
    inner = F.when(F.schema_of_variant("body") == "STRING", F.try_parse_json(F.try_variant_get(F.col("body"), "$", "string"))).otherwise(F.col("body"))
    return rows.withColumn("body", inner).where("body is not null")
