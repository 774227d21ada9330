"""One answer for each question out of repeated samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def representative(samples: DataFrame) -> DataFrame:
    """The first eligible sample of each question by (repeat_index, sample_id), else the first of any.

    Adds `repeated`: more than one was eligible. `samples(run_id, question_id, sample_id, repeat_index, eligible, ...)`.
    """
    key = F.struct((~F.coalesce("eligible", F.lit(False))).alias("off"), "repeat_index", "sample_id")
    rest = [c for c in samples.columns if c not in ("run_id", "question_id")]
    # A minimum is kept while rows are read, so a question of very many repeats is never sorted in one task.
    first = samples.where("run_id is not null and question_id is not null").groupBy("run_id", "question_id").agg(
        F.min_by(F.struct(*rest), key).alias("_s"), (F.count_if("eligible") > 1).alias("repeated")
    )
    return first.select("run_id", "question_id", "_s.*", "repeated")


def answers(selected: DataFrame, questions: DataFrame) -> DataFrame:
    """A row for each question with its selected sample, if any; `valid` only if that is eligible."""
    picked = selected.select("run_id", "question_id", "sample_id", "eligible", "repeated")
    return questions.join(picked, ["run_id", "question_id"], "left").withColumn("valid", F.coalesce("eligible", F.lit(False)))


def coverage(answered: DataFrame) -> DataFrame:
    """(run_id, designed, valid, invalid_or_missing, valid_generic) from `answers`."""
    return answered.groupBy("run_id").agg(
        F.count("*").alias("designed"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid_or_missing"),
        F.count_if(F.col("valid") & (F.col("question_type") == "generic")).alias("valid_generic"),
    )


def crawl_counts(samples: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Counts of samples by status; planned is the plan's size or the number of rows, whichever is more (A10)."""
    n = lambda s: F.count_if(F.col("status") == s)
    counts = samples.groupBy("run_id").agg(
        F.count("*").alias("rows"), n("success").alias("valid"), n("failed").alias("failed"), n("invalid").alias("invalid"), n("pending").alias("pending")
    )
    plan = planned.groupBy("run_id").agg(F.count("*").alias("plan_rows")) if planned is not None else None
    joined = counts.join(plan, "run_id", "left") if plan is not None else counts.withColumn("plan_rows", F.lit(0))
    return joined.select(
        "run_id", F.greatest("rows", F.coalesce("plan_rows", F.lit(0))).alias("planned"), (F.col("rows") - F.col("pending")).alias("completed"), "valid",
        "failed", "invalid", "pending"
    )
