"""Sentiment judgements, given as a table, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import or_empty, percent, ratio, strip
from .numbering import numbered

BATCH = 10


def label_of(score: Column) -> Column:
    return F.when(score > 0.1, "positive").when(score < -0.1, "negative").when(score.isNotNull(), "neutral")


def work_list(answers: DataFrame, found: DataFrame) -> DataFrame:
    """Valid answers that name the target, in batches of ten."""
    named = answers.where("valid").join(found.where("object_id = 'target'").select("run_id", "answer_id"), ["run_id", "answer_id"], "left_semi")
    placed = numbered(named.select("run_id", "answer_id"), "run_id", "answer_id", "place")
    return placed.select("run_id", "answer_id", F.floor((F.col("place") - 1) / BATCH).alias("batch_no"))


def latest(results: DataFrame) -> DataFrame:
    """The last attempt of each judgement (W6); of rows that repeat an attempt the least in its other columns."""
    others = [F.col(c) for c in sorted(results.columns) if c not in ("run_id", "answer_id", "attempt")]
    order = Window.partitionBy("run_id", "answer_id").orderBy(F.col("attempt").desc(), *others)
    return results.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def with_findings(results: DataFrame, answers: DataFrame) -> DataFrame:
    """Add `finding`: null for a sound judgement, else what is wrong with it.

    `results(run_id, answer_id, attempt, label, score, confidence, evidence array<string>)`.
    """
    joined = results.join(answers.select("run_id", "answer_id", "answer_text"), ["run_id", "answer_id"], "left")
    quotes = F.transform(F.coalesce("evidence", F.array().cast("array<string>")), lambda q: strip(or_empty(q)))
    exact = F.forall(quotes, lambda q: (q != "") & F.contains(or_empty(F.col("answer_text")), q))
    finding = (
        F.when(~F.coalesce(F.col("label").isin("positive", "neutral", "negative"), F.lit(False)), "LABEL")
        .when(~F.coalesce(F.col("score").between(-1, 1) & F.col("confidence").between(0, 1), F.lit(False)), "RANGE")
        .when(label_of(F.col("score")) != F.col("label"), "LABEL_SCORE_MISMATCH")
        .when(F.size(quotes) == 0, "NO_EVIDENCE")
        .when(~exact, "EVIDENCE_NOT_IN_ANSWER")
    )
    return joined.withColumn("finding", finding).drop("answer_text")


def routed(results: DataFrame, threshold: float) -> DataFrame:
    """Add status: accepted from the threshold up, else review on the first attempt, then unresolved."""
    return results.withColumn("status", F.when(F.col("confidence") >= threshold, "accepted").when(F.col("attempt") < 2, "review").otherwise("unresolved"))


def work_findings(work: DataFrame, results: DataFrame) -> DataFrame:
    """(run_id, answer_id, code) of answers asked for and not judged, or judged and not asked for."""
    both = work.select("run_id", "answer_id", F.lit(1).alias("w")).join(
        results.select("run_id", "answer_id", F.lit(1).alias("r")).distinct(), ["run_id", "answer_id"], "full_outer"
    )
    return both.where("w is null or r is null").select("run_id", "answer_id", F.when(F.col("w").isNull(), "UNEXPECTED").otherwise("MISSING").alias("code"))


def target_sentiment(answers: DataFrame, found: DataFrame, results: DataFrame) -> DataFrame:
    """Counts of accepted labels over valid answers that name the target, and their shares (A4).

    The positive ratio leaves neutral ones out; the distribution has all three.
    """
    named = answers.where("valid").select("run_id", "answer_id").join(
        found.where("object_id = 'target'").select("run_id", "answer_id"), ["run_id", "answer_id"], "left_semi"
    )
    judged = named.join(results.select("run_id", "answer_id", "label", "status"), ["run_id", "answer_id"], "left")
    n = lambda x: F.count_if((F.col("status") == "accepted") & (F.col("label") == x))
    counts = judged.groupBy("run_id").agg(
        n("positive").alias("positive"), n("neutral").alias("neutral"), n("negative").alias("negative"),
        F.count_if(F.coalesce(F.col("status") != "accepted", F.lit(True))).alias("unresolved")
    )
    all_ = F.col("positive") + F.col("neutral") + F.col("negative")
    sided = F.col("positive") + F.col("negative")
    return counts.select(
        "run_id", "positive", "neutral", "negative", "unresolved", ratio(F.col("positive"), sided).alias("positive_ratio"),
        percent(F.col("positive"), sided).alias("positive_display"), *[ratio(F.col(x), all_).alias(f"{x}_share") for x in ("positive", "neutral", "negative")]
    )


def unresolved_answers(answers: DataFrame, found: DataFrame, results: DataFrame) -> DataFrame:
    """(run_id, answer_id) of valid answers that name the target without an accepted judgement."""
    named = answers.where("valid").select("run_id", "answer_id").join(
        found.where("object_id = 'target'").select("run_id", "answer_id"), ["run_id", "answer_id"], "left_semi"
    )
    return named.join(results.where("status = 'accepted'").select("run_id", "answer_id"), ["run_id", "answer_id"], "left_anti")


def evidence(results: DataFrame) -> DataFrame:
    """`E-{answer}-{nn}` rows of the quotes of accepted judgements."""
    rows = results.where("status = 'accepted'").select("run_id", "answer_id", "label", F.posexplode("evidence").alias("pos", "quote"))
    return rows.select(
        "run_id", F.format_string("E-%s-%02d", F.col("answer_id").cast("string"), F.col("pos") + 1).alias("evidence_id"), "answer_id", "label", "quote"
    )


def theme_findings(themes: DataFrame, proof: DataFrame) -> DataFrame:
    """(run_id, theme_id, evidence_id, code): evidence that is unknown, or of the other polarity.

    `themes(run_id, theme_id, polarity, evidence_ids)`.
    """
    each = themes.select("run_id", "theme_id", "polarity", F.explode("evidence_ids").alias("evidence_id"))
    joined = each.join(proof.select("run_id", "evidence_id", "label"), ["run_id", "evidence_id"], "left")
    code = F.when(F.col("label").isNull(), "UNKNOWN_EVIDENCE").when(F.col("label") != F.col("polarity"), "POLARITY")
    return joined.withColumn("code", code).where("code is not null").select("run_id", "theme_id", "evidence_id", "code")


def theme_support(themes: DataFrame, proof: DataFrame) -> DataFrame:
    """(run_id, theme_id, support): distinct answers behind a theme."""
    each = themes.select("run_id", "theme_id", F.explode("evidence_ids").alias("evidence_id"))
    return each.join(
        proof.select("run_id", "evidence_id", "answer_id"), ["run_id", "evidence_id"]
    ).groupBy("run_id", "theme_id").agg(F.countDistinct("answer_id").alias("support"))
