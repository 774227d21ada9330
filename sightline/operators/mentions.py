"""Brand mentions: which objects an answer names, in what order (J5, W2), and their rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import alias_pattern, average_display, first_position, nfkc, or_empty, percent, ratio, spans


def alias_patterns(aliases: DataFrame) -> DataFrame:
    """(run_id, object_id, display_order, alias, pattern): each alias with the pattern that finds it."""
    return aliases.withColumn("pattern", alias_pattern(F.col("alias")))


def mention_spans(answers: DataFrame, patterns: DataFrame) -> DataFrame:
    """(run_id, answer_id, object_id, spans) of eligible answers that name the object.

    Spans of different aliases may overlap and all stay; they are ordered by start, longest first.
    """
    hit = answers.select(
        "run_id", "answer_id", nfkc(or_empty(F.col("answer_text"))).alias("t")
    ).join(patterns.select("run_id", "object_id", "alias", "pattern"), "run_id").where(F.rlike("t", F.col("pattern")))
    each = hit.select("run_id", "answer_id", "object_id", F.explode(spans(F.col("t"), F.col("pattern"), F.col("alias"))).alias("s")).distinct()
    order = F.struct(F.col("s.start"), (-(F.col("s.end") - F.col("s.start"))).alias("len"), F.lower("s.alias").alias("a"), F.col("s"))
    return each.groupBy("run_id", "answer_id", "object_id").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["s"]).alias("spans"))


def run_patterns(patterns: DataFrame) -> DataFrame:
    """(run_id, objects): a run's objects, each with its display order and one pattern for all its aliases.

    Of alternatives a search finds the leftmost, which is where the first of the aliases stands.
    """
    own = patterns.groupBy("run_id", "object_id", "display_order").agg(F.array_join(F.array_sort(F.collect_set("pattern")), "|").alias("pattern"))
    return own.groupBy("run_id").agg(F.collect_list(F.struct("object_id", "display_order", "pattern")).alias("objects"))


def mentions(answers: DataFrame, patterns: DataFrame) -> DataFrame:
    """(run_id, answer_id, object_id, display_order, first_position, report_rank) of objects that answers name.

    `answers(run_id, answer_id, answer_text)`, a row an answer; `patterns` from `alias_patterns`. The text is searched
    once for each object, up to its first match; ranks follow first positions, then display order. An answer is
    ranked within its row, so no answer is shuffled.
    """
    text = answers.select("run_id", "answer_id", nfkc(or_empty(F.col("answer_text"))).alias("t")).join(run_patterns(patterns), "run_id")
    each = F.transform(
        "objects",
        lambda o: F.struct(first_position(F.col("t"), o["pattern"]).alias("at"), o["display_order"].alias("display_order"), o["object_id"].alias("object_id"))
    )
    named = F.array_sort(F.filter(each, lambda x: x["at"].isNotNull()))
    found = text.select("run_id", "answer_id", F.posexplode(named).alias("pos", "x"))
    return found.select("run_id", "answer_id", "x.object_id", "x.display_order", F.col("x.at").alias("first_position"), (F.col("pos") + 1).alias("report_rank"))


def object_metrics(answers: DataFrame, found: DataFrame, objects: DataFrame) -> DataFrame:
    """A row for each run and object: mention rate, share of voice and average rank over generic answers.

    `answers(run_id, answer_id, question_type)` are the valid ones. Zero denominators give null and `—`.
    """
    generic = answers.where("question_type = 'generic'")
    totals = generic.groupBy("run_id").agg(F.count("*").alias("answers"))
    counts = found.join(
        generic.select("run_id", "answer_id"), ["run_id", "answer_id"], "left_semi"
    ).groupBy("run_id", "object_id").agg(F.count("*").alias("mentions"), F.sum("report_rank").alias("rank_sum"))
    rows = objects.select("run_id", "object_id", "role", "display_order").join(totals, "run_id", "left").join(counts, ["run_id", "object_id"], "left").fillna(0, ["answers", "mentions", "rank_sum"])
    voices = F.sum("mentions").over(Window.partitionBy("run_id"))
    return rows.withColumn("all_mentions", voices).select(
        "run_id", "object_id", "role", "display_order", "answers", "mentions", "all_mentions", "rank_sum",
        ratio(F.col("mentions"), F.col("answers")).alias("mention_rate"), percent(F.col("mentions"), F.col("answers")).alias("mention_display"),
        ratio(F.col("mentions"), F.col("all_mentions")).alias("share_of_voice"), percent(F.col("mentions"), F.col("all_mentions")).alias("voice_display"),
        ratio(F.col("rank_sum"), F.col("mentions")).alias("average_rank"), average_display(F.col("rank_sum"), F.col("mentions")).alias("rank_display"),
    )


def mention_lineage(answers: DataFrame, found: DataFrame) -> DataFrame:
    """(run_id, object_id, answer_id): the generic answers behind each mention rate, a row each."""
    generic = answers.where("question_type = 'generic'").select("run_id", "answer_id")
    return found.join(generic, ["run_id", "answer_id"], "left_semi").select("run_id", "object_id", "answer_id")


def voice_check(metrics: DataFrame) -> DataFrame:
    """(run_id, passed): shares of voice add up to one, or there are none."""
    total = F.sum("share_of_voice")
    return metrics.groupBy("run_id").agg((total.isNull() | (F.abs(total - 1.0) < 1e-9)).alias("passed"))
