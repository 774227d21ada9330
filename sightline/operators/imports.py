"""Checks on imported question banks and run configurations.

Each finding is a row (run_id, code, question_id or object_id, detail); one that blocks an import and one that only
warns differ in `severity`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import casefold, nfkc, or_empty
from .bank import alias_conflicts
from .numbering import numbered


def is_english(text: Column) -> Column:
    """Whether a text holds a letter of ASCII."""
    return or_empty(text).rlike("[A-Za-z]")


def _codes(*rules: tuple[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(hit, F.lit(False)), F.lit(code)) for code, hit in rules]), lambda c: c.isNotNull())


def _rows(df: DataFrame, code: str | Column, key: str | None = None, detail: Column | None = None, severity: str = "error") -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        "run_id", (F.lit(code) if isinstance(code, str) else code).alias("code"), (F.col(key) if key else none).cast("string").alias("question_id"),
        (detail if detail is not None else none).cast("string").alias("detail"), F.lit(severity).alias("severity")
    )


def named_objects(questions: DataFrame, patterns: DataFrame) -> DataFrame:
    """(run_id, place, object_id, role) of the objects that questions name (J19). `patterns(run_id, object_id, role, pattern)`."""
    own = patterns.groupBy("run_id", "object_id", "role").agg(F.array_join(F.array_sort(F.collect_set("pattern")), "|").alias("pattern"))
    per_run = own.groupBy("run_id").agg(F.collect_list(F.struct("object_id", "role", "pattern")).alias("objects"))
    text = questions.select("run_id", "place", nfkc(or_empty(F.col("question_text"))).alias("t")).join(per_run, "run_id")
    return text.select(
        "run_id", "place", F.explode(F.filter("objects", lambda o: F.rlike(F.col("t"), o["pattern"]))).alias("o")
    ).select("run_id", "place", "o.object_id", "o.role")


def question_findings(questions: DataFrame, patterns: DataFrame, runs: DataFrame) -> DataFrame:
    """Findings of imported questions, from `ingest.import_questions`: a row each.

    Elements that are no objects are reported and count for nothing else. Rules of a run as a whole (total, quota of
    types, missing intents, repeated ids) are counted over its objects. `runs` hold quotas; a run without
    any question is checked too.
    """
    off = questions.where("not is_object")
    rows = questions.where("is_object")
    single = _codes(
        ("NO_TEXT", F.col("question_text").isNull()), ("BAD_TYPE", F.col("question_type").isNull()), ("BAD_INTENT", F.col("funnel_intent").isNull()),
        ("NOT_ENGLISH", F.col("question_text").isNotNull() & ~is_english(F.col("question_text"))),
    )
    out = _rows(off, "NOT_AN_OBJECT", "question_id").unionByName(_rows(rows.withColumn("_c", F.explode(single)), F.col("_c"), "question_id"))
    warned = _codes(("NO_TRANSLATION", F.col("question_zh").isNull()), ("LEGACY_LABEL", F.col("migrated")))
    out = out.unionByName(_rows(rows.withColumn("_c", F.explode(warned)), F.col("_c"), "question_id", severity="warning"))
    hits = named_objects(rows, patterns)
    names = hits.groupBy("run_id", "place").agg(
        F.array_join(F.array_sort(F.collect_set("object_id")), ",").alias("names"), F.max((F.col("role") == "target").cast("int")).alias("own")
    )
    named = rows.join(names, ["run_id", "place"], "left")
    out = out.unionByName(_rows(named.where("question_type = 'generic' and names is not null"), "GENERIC_NAMES_OBJECT", "question_id", F.col("names")))
    out = out.unionByName(_rows(named.where("question_type = 'branded' and coalesce(own, 0) = 0"), "BRANDED_WITHOUT_TARGET", "question_id"))
    twice = rows.groupBy("run_id", casefold(F.col("question_id")).alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    out = out.unionByName(_rows(twice, "DUPLICATE_ID", "key", F.col("n")))
    count = lambda column, value: F.count_if(F.col(column) == value).alias(value)
    counts = rows.groupBy("run_id").agg(
        F.count("*").alias("questions"), *[count("question_type", t) for t in ("generic", "branded")],
        *[count("funnel_intent", i) for i in fixed.COMMERCIAL_INTENTS]
    )
    every = runs.select("run_id", "quota_total", "quota_generic", "quota_branded").join(counts, "run_id", "left").fillna(
        0, ["questions", "generic", "branded", *fixed.COMMERCIAL_INTENTS]
    )
    missing = _codes(*[(i, F.col(i) == 0) for i in fixed.COMMERCIAL_INTENTS])
    return (
        out.unionByName(_rows(every.where("questions != quota_total"), "TOTAL", None, F.format_string("%d/%d", "questions", "quota_total")))
        .unionByName(
            _rows(
                every.where("generic != quota_generic or branded != quota_branded"), "TYPE_QUOTA", None,
                F.format_string("%d,%d/%d,%d", "generic", "branded", "quota_generic", "quota_branded")
            )
        )
        .unionByName(_rows(every.withColumn("_i", F.explode(missing)), "NO_INTENT", None, F.col("_i")))
    )


def ordered_questions(questions: DataFrame) -> DataFrame:
    """Add `order_no`, the place of a question in its run by sequence, then case-folded id, then place (L4)."""
    key = F.struct("sequence", casefold(F.col("question_id")).alias("id"), "place")
    return numbered(questions.withColumn("_key", key), "run_id", "_key", "order_no").drop("_key")


def ordered_samples(samples: DataFrame) -> DataFrame:
    """Add `order_no`, the place of a sample in its run by question index, repeat index and id (L3); a missing index stands first."""
    key = F.struct(
        F.coalesce("question_index", F.lit(0)).alias("question"), F.coalesce("repeat_index", F.lit(0)).alias("repeat"),
        F.coalesce("sample_id", F.lit("")).alias("id")
    )
    return numbered(samples.withColumn("_key", key), "run_id", "_key", "order_no").drop("_key")


def run_findings(runs: DataFrame, objects: DataFrame, aliases: DataFrame, domains: DataFrame) -> DataFrame:
    """(run_id, code, detail): configurations that no run may start from.

    `runs` from `ingest.import_runs`, the others from `ingest.import_objects`.
    """
    rivals = objects.groupBy("run_id").agg(F.count_if(F.col("role") == "competitor").alias("rivals"))
    rows = runs.join(rivals, "run_id", "left").fillna(0, ["rivals"])
    codes = _codes(
        ("NO_TOPIC", F.col("topic") == ""), ("ONE_TOPIC", F.col("topics") != 1), ("MARKET", ~F.col("market").isin(*fixed.MARKETS)),
        ("LANGUAGE", ~F.col("language").isin(*fixed.LANGUAGES)),
        ("PLATFORM", ~F.col("platform").isin(*fixed.PLATFORMS)), ("COMPETITORS", ~F.col("rivals").between(1, 3)),
        ("THRESHOLD", ~F.col("sentiment_threshold").between(0.5, 1)),
        ("SAMPLE_POLICY", F.col("sample_policy") != fixed.SAMPLE_POLICY), (
            "QUOTA_SUM", F.col("quota_generic") + F.col("quota_branded") != F.col("quota_total")
        ),
    )
    none = F.lit(None).cast("string")
    out = rows.select("run_id", F.explode(codes).alias("code"), none.alias("detail"))
    brand = runs.select("run_id").join(objects.where("role = 'target' and canonical_name is not null").select("run_id"), "run_id", "left_anti")
    nameless = objects.where("role = 'competitor' and canonical_name is null").select(
        "run_id", F.lit("NO_NAME").alias("code"), F.col("object_id").alias("detail")
    )
    homeless = objects.join(domains.select("run_id", "object_id"), ["run_id", "object_id"], "left_anti").where("canonical_name is not null").select(
        "run_id", F.lit("NO_DOMAIN").alias("code"), F.col("object_id").alias("detail")
    )
    shared = alias_conflicts(aliases).select("run_id", F.lit("SHARED_ALIAS").alias("code"), F.col("alias_norm").alias("detail"))
    return out.unionByName(
        brand.select("run_id", F.lit("NO_NAME").alias("code"), F.lit("target").alias("detail"))
    ).unionByName(nameless).unionByName(homeless).unionByName(shared)
