"""Citations: canonical URLs, classes, and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions.text import percent, ratio
from ..functions.urls import normalize_host, normalize_url, registrable_domain, suffixes
from .numbering import numbered


def canonical(citations: DataFrame) -> DataFrame:
    """Add canonical_url, host, registrable_domain, removed_params; the hint is the host only without a URL."""
    url = normalize_url(F.col("raw_url"))
    host = F.coalesce(url.host, normalize_host(F.col("domain_hint")) if "domain_hint" in citations.columns else F.lit(None).cast("string"))
    return citations.withColumn("canonical_url", url.canonical).withColumn("host", host).withColumn("removed_params", url.removed).withColumn("registrable_domain", registrable_domain(F.col("host")))


def is_institution(host: Column) -> Column:
    return F.endswith(host, F.lit(".gov")) | F.contains(host, F.lit(".gov.")) | F.endswith(host, F.lit(".edu")) | F.contains(host, F.lit(".edu."))


def official_domains(domains: DataFrame) -> DataFrame:
    """(run_id, official): a run's official domains as a map to whose they are; an object's own order decides for shared ones."""
    first = domains.groupBy("run_id", "domain").agg(F.min(F.struct("display_order", "domain_pos", "object_id", "role")).alias("owner"))
    return first.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("domain", "owner"))).alias("official"))


def classify(citations: DataFrame, domains: DataFrame) -> DataFrame:
    """Add matched_object, source_type, classification_source, confidence.

    A host's dot suffixes are looked up in the run's map of official domains and in that of known hosts, so a
    citation is classified within its row. Of several official domains the first in object and domain order wins.
    """
    near = suffixes(F.col("host"))
    found = lambda table: F.filter(F.transform(near, lambda x: F.try_element_at(table, x)), lambda o: o.isNotNull())
    known = F.create_map(*[F.lit(x) for pair in fixed.KNOWN_HOSTS.items() for x in pair])
    rows = citations.join(official_domains(domains), "run_id", "left").select(
        *citations.columns, F.array_min(found(F.col("official"))).alias("_o"), F.array_max(found(known)).alias("_known")
    )
    own = F.when(F.col("_o.role") == "target", "brand_official").when(F.col("_o").isNotNull(), "competitor_official")
    rule = F.coalesce("_known", F.when(is_institution(F.col("host")), "institutional"))
    return rows.select(
        *citations.columns, F.col("_o.object_id").alias("matched_object"), F.coalesce(own, rule, F.lit("other")).alias("source_type"),
        F.when(own.isNotNull(), "official_rule").when(rule.isNotNull(), "domain_rule").otherwise("default_other").alias("classification_source"),
        F.when(own.isNotNull(), 1.0).when(rule.isNotNull(), 0.95).alias("confidence"),
    )


def first_of_page(classified: DataFrame) -> DataFrame:
    """The first citation of each page in an answer (W3); rows without a canonical URL are left out."""
    order = Window.partitionBy("run_id", "answer_id", "canonical_url").orderBy("citation_no")
    return classified.where("canonical_url is not null").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def official_share(classified: DataFrame) -> DataFrame:
    """(run_id, official, citations, share, display) over raw citations (A5)."""
    counts = classified.groupBy("run_id").agg(F.count_if(F.col("matched_object") == "target").alias("official"), F.count("*").alias("citations"))
    return counts.withColumn("share", ratio(F.col("official"), F.col("citations"))).withColumn("display", percent(F.col("official"), F.col("citations")))


def type_distribution(pages: DataFrame) -> DataFrame:
    """(run_id, source_type, n, share) of pages cited, zero types included."""
    types = F.explode(F.array(*[F.lit(t) for t in fixed.SOURCE_TYPES])).alias("source_type")
    counts = pages.groupBy("run_id", "source_type").agg(F.count("*").alias("n"))
    totals = counts.groupBy("run_id").agg(F.sum("n").alias("total"))
    return totals.select("run_id", "total", types).join(counts, ["run_id", "source_type"], "left").select(
        "run_id", "source_type", F.coalesce("n", F.lit(0)).alias("n"), ratio(F.coalesce("n", F.lit(0)), F.col("total")).alias("share")
    )


def top_keys(pages: DataFrame, key: str, limit: int = 8) -> DataFrame:
    """(run_id, key, answers, place): keys that most answers cite, ties by key."""
    value = F.coalesce("registrable_domain", "host") if key == "domain" else F.col("canonical_url")
    counts = pages.withColumn("key", value).where("key is not null").groupBy("run_id", "key").agg(F.countDistinct("answer_id").alias("answers"))
    order = Window.partitionBy("run_id").orderBy(F.col("answers").desc(), "key")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)


def top_official_pages(pages: DataFrame, limit: int = 8) -> DataFrame:
    return top_keys(pages.where("matched_object = 'target'"), "page", limit)


def _unruled(classified: DataFrame) -> DataFrame:
    return classified.where("classification_source = 'default_other' and canonical_url is not null and host is not null")


def unknown_hosts(classified: DataFrame, examples: int = 3) -> DataFrame:
    """Work list of hosts without a rule, `S-001`.. by host, each with its first distinct urls, titles and summaries.

    A value counts where it first appears; all but the first few are gone before values are listed.
    """
    open_ = _unruled(classified)
    names = [c for c in ("canonical_url", "title", "summary") if c in classified.columns]
    each = open_.select(
        "run_id", "host", F.struct("answer_id", "citation_no").alias("at"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in names])).alias("x")
    ).select("run_id", "host", "at", "x.*")
    seen = each.where("value is not null and value != ''").groupBy("run_id", "host", "name", "value").agg(F.min("at").alias("at"))
    order = Window.partitionBy("run_id", "host", "name").orderBy("at", "value")
    few = seen.withColumn("k", F.row_number().over(order)).where(F.col("k") <= examples)
    lists = few.groupBy("run_id", "host").agg(
        *[F.transform(F.array_sort(F.collect_list(F.when(F.col("name") == c, F.struct("k", "value")))), lambda x: x["value"]).alias(c + "s") for c in names]
    )
    hosts = open_.groupBy("run_id", "host").agg(F.count("*").alias("citations")).join(lists, ["run_id", "host"], "left")
    return numbered(hosts, "run_id", "host", "place").withColumn("item_id", F.format_string("S-%03d", "place")).drop("place")


def work_citations(classified: DataFrame, work: DataFrame) -> DataFrame:
    """(run_id, item_id, citation_id): the citations that each work item decides."""
    return _unruled(classified).join(work.select("run_id", "host", "item_id"), ["run_id", "host"]).select("run_id", "item_id", "citation_id")


def apply_decisions(classified: DataFrame, work: DataFrame, decisions: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Judged types replace `default_other` ones; below the threshold the type stays `other`."""
    allowed = [t for t in fixed.SOURCE_TYPES if t not in ("brand_official", "competitor_official")]
    good = decisions.where(F.col("source_type").isin(*allowed) & F.col("confidence").between(0, 1)).select(
        "run_id", "item_id", F.col("source_type").alias("judged"), F.col("confidence").alias("judged_confidence")
    )
    by_host = work.select("run_id", "host", "item_id").join(good, ["run_id", "item_id"]).drop("item_id")
    joined = classified.join(by_host, ["run_id", "host"], "left")
    open_ = (F.col("classification_source") == "default_other") & F.col("canonical_url").isNotNull() & F.col("judged").isNotNull()
    sure = open_ & (F.col("judged_confidence") >= threshold)
    return joined.select(
        *[c for c in classified.columns if c not in ("source_type", "confidence", "classification_source")],
        F.when(sure, F.col("judged")).otherwise(F.col("source_type")).alias("source_type"),
        F.when(open_, F.col("judged_confidence")).otherwise(F.col("confidence")).alias("confidence"),
        F.when(sure, "model_fallback").otherwise(F.col("classification_source")).alias("classification_source"),
    )


def decision_findings(work: DataFrame, decisions: DataFrame) -> DataFrame:
    """(run_id, item_id, code): items missing or unexpected, types and confidences not allowed."""
    both = work.select("run_id", "item_id", F.lit(1).alias("w")).join(
        decisions.select("run_id", "item_id", "source_type", "confidence", F.lit(1).alias("d")), ["run_id", "item_id"], "full_outer"
    )
    code = F.when(F.col("d").isNull(), "MISSING").when(F.col("w").isNull(), "UNEXPECTED").when(
        ~F.coalesce(F.col("source_type").isin(*fixed.SOURCE_TYPES) & ~F.col("source_type").isin("brand_official", "competitor_official"), F.lit(False)), "TYPE"
    ).when(~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)), "RANGE")
    return both.withColumn("code", code).where("code is not null").select("run_id", "item_id", "code")
