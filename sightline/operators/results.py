"""Opportunities, benchmarks, action states and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed
from ..functions.text import or_empty, ratio
from ..session import written
from .mentions import voice_check
from .numbering import ordered_digests

BUCKETS = ("priority_improve", "continue_optimize", "stable")


def intent_priority(intent: Column) -> Column:
    return reduce(lambda c, x: c.when(intent == x[0], x[1]), fixed.INTENT_PRIORITY.items(), F.when(F.lit(False), 0)).otherwise(9)


def opportunities(answers: DataFrame, found: DataFrame) -> DataFrame:
    """Each valid generic answer with its bucket: target absent, ranked fourth or later, or above."""
    target = found.where("object_id = 'target'").select("run_id", "answer_id", "report_rank")
    rows = answers.where("valid and question_type = 'generic'").join(target, ["run_id", "answer_id"], "left")
    bucket = F.when(F.col("report_rank").isNull(), BUCKETS[0]).when(F.col("report_rank") >= 4, BUCKETS[1]).otherwise(BUCKETS[2])
    return rows.select("run_id", "answer_id", "funnel_intent", "sequence", "report_rank", bucket.alias("bucket"))


def opportunity_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run_id").agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])


def opportunity_top(rows: DataFrame, limit: int = 3) -> DataFrame:
    """The first few of each bucket: by intent, then worst rank first where there is room, best first where stable."""
    rank = F.when(F.col("bucket") == "continue_optimize", -F.col("report_rank")).when(F.col("bucket") == "stable", F.col("report_rank")).otherwise(0)
    order = Window.partitionBy("run_id", "bucket").orderBy(intent_priority(F.col("funnel_intent")), rank, "sequence", "answer_id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)


def benchmarks(metrics: DataFrame) -> DataFrame:
    """(run_id, metric, best_value, selected_competitor, tied): the best competitor in three metrics."""
    rivals = metrics.where("role = 'competitor'").select(
        "run_id", "object_id", "display_order",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(s).alias("sign")) for m,
                    s in (("mention_rate", 1.0), ("share_of_voice", 1.0), ("average_rank", -1.0))
                ]
            )
        ).alias("x")
    ).select("run_id", "object_id", "display_order", "x.*").where("value is not null")
    best = rivals.withColumn("best", F.max(F.col("value") * F.col("sign")).over(Window.partitionBy("run_id", "metric"))).where("value * sign = best")
    return best.groupBy("run_id", "metric").agg(
        F.max("value").alias("best_value"), F.min_by("object_id", "display_order").alias("selected_competitor"),
        F.transform(F.array_sort(F.collect_list(F.struct("display_order", "object_id"))), lambda x: x["object_id"]).alias("tied")
    )


def action_states(metrics: DataFrame, best: DataFrame, counts: DataFrame, share: DataFrame, official_pages: DataFrame, sentiment: DataFrame) -> DataFrame:
    """(run_id, direction, state): up to three directions of each run.

    Doubles are compared as they are. A direction is left out without generic answers, citations or
    accepted judgements respectively.
    """
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("best_value")))
    rivals = best.groupBy("run_id").agg(of("mention_rate").alias("best_rate"), of("average_rank").alias("best_rank"))
    target = metrics.where("role = 'target'").select("run_id", "answers", "mention_rate", "average_rank")
    pages = official_pages.groupBy("run_id").agg(F.count("*").alias("pages"))
    row = target.join(rivals, "run_id", "left").join(counts.select("run_id", "priority_improve"), "run_id", "left").join(
        share.select("run_id", "citations", F.col("share").alias("official")), "run_id", "left"
    ).join(pages, "run_id", "left")
    row = row.join(sentiment.select("run_id", "positive_share", "negative_share"), "run_id", "left")
    no = F.lit(False)
    absent = F.coalesce(F.col("best_rate") - F.col("mention_rate") >= 0.10, no) | F.coalesce(ratio(F.col("priority_improve"), F.col("answers")) >= 0.20, no)
    lag = F.coalesce(F.col("average_rank") - F.col("best_rank") >= 1.0, no)
    entry = F.when(F.col("answers") > 0, F.when(absent, "absent").when(lag, "position_lag").otherwise("no_significant_gap"))
    cited = F.when(
        F.col("citations") > 0, F.when(F.col("official") < 0.10, "weak").when(F.coalesce("pages", F.lit(0)) <= 2, "insufficient_coverage").otherwise("stable")
    )
    said = F.when(
        F.col("positive_share").isNotNull(), F.when(F.col("negative_share") >= 0.15, "risk").when(F.col("positive_share") < 0.50, "flat").otherwise("positive")
    )
    states = F.array(
        *[
            F.struct(F.lit(n).alias("direction"), s.alias("state")) for n,
            s in (("brand_entry", entry), ("citation_evidence", cited), ("brand_expression", said))
        ]
    )
    return row.select("run_id", F.explode(states).alias("x")).select("run_id", "x.*").where("state is not null")


def publish_checks(
    runs: DataFrame, coverage: DataFrame, counts: DataFrame, metrics: DataFrame, sentiment: DataFrame, artefacts: DataFrame, inputs: DataFrame, tasks: DataFrame
) -> DataFrame:
    """(run_id, code, passed, severity): a row for each check of each run; all block.

    `runs(run_id, quota_total, config_hash, frozen_at, answers_hash, metrics_hash)`; `artefacts(run_id, artefact,
    own_run_id)`: the run that each artefact names; `inputs(run_id, input, used, current)`: hashes that the metrics
    were computed from, and those of the inputs now; `tasks(run_id, status)`. A run without rows there
    passes the check. Each table is grouped by run before it is joined.
    """
    of = lambda rows, hit, name: rows.groupBy("run_id").agg(F.bool_and(hit).alias(name))
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    row = runs.join(coverage, "run_id", "left").join(counts, "run_id", "left").join(
        voice_check(metrics).withColumnRenamed("passed", "voices"), "run_id", "left"
    ).join(sentiment.select("run_id", "unresolved"), "run_id", "left")
    row = row.join(
        of(artefacts, same("own_run_id", "run_id"), "one_batch"), "run_id", "left"
    ).join(of(inputs, same("used", "current"), "same_inputs"), "run_id", "left").join(
        of(tasks, F.coalesce(F.col("status") != "pending", F.lit(False)), "resolved"), "run_id", "left"
    )
    total = sum((F.coalesce(b, F.lit(0)) for b in BUCKETS), F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0))
    held = lambda *names: sum(((or_empty(F.col(n)) != "").cast("int") for n in names), F.lit(0)) == len(names)
    checks = {
        "CONFIG_FROZEN": held("config_hash", "frozen_at"),
        "QUESTION_TOTAL": zero("designed") == F.col("quota_total"),
        "VALID_ANSWER_PRESENT": zero("valid") > 0,
        "BATCH_CONSISTENT": F.coalesce("one_batch", F.lit(True)),
        "METRIC_INPUT_HASHES": F.coalesce("same_inputs", F.lit(True)),
        "TARGET_SENTIMENT_COMPLETE": zero("unresolved") == 0,
        "OPPORTUNITY_PARTITION": total == zero("valid_generic"),
        "VOICE_INVARIANT": F.coalesce("voices", F.lit(True)),
        "TASKS_RESOLVED": F.coalesce("resolved", F.lit(True)),
        "TRACEABILITY_PRESENT": held("answers_hash", "metrics_hash"),
    }
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("code"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in checks.items()]))
    return row.select("run_id", each.alias("x")).select("run_id", "x.*", F.lit("blocking").alias("severity"))


def publishable(checks: DataFrame) -> DataFrame:
    return checks.groupBy("run_id").agg(F.bool_and("passed").alias("publishable"), F.count_if(~F.col("passed")).alias("failed_checks"))


def batch_findings(parts: DataFrame) -> DataFrame:
    """Groups of artefacts whose ids differ: `parts(group_id, artefact, run_id)`."""
    return parts.groupBy("group_id").agg(F.countDistinct("run_id").alias("runs"), F.count("*").alias("artefacts")).where("runs > 1")


#: Ranges that a level of digests parts the keys into, and levels of them.
DIGEST_RANGES, DIGEST_LEVELS, FEW = 4096, 2, 16


def differing_rows(computed: DataFrame, supplied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in ranges of hashed keys whose digests differ.

    A range's digest is its count and the sum of its rows' hashes, summed up before the shuffle, so the first level
    shuffles at most DIGEST_RANGES rows a task. The next looks only into ranges that differ, and is taken only where
    those are at most one in FEW; so the numbers of ranges that are broadcast are bounded by DIGEST_RANGES ** 2 / FEW.
    """
    numbered = lambda rows: rows.withColumn("_key", F.xxhash64("run_id", "metric"))
    sides = [numbered(computed.select("run_id", "metric", "value")), numbered(supplied.select("run_id", "metric", "value"))]
    size = 1
    for _ in range(DIGEST_LEVELS):
        size *= DIGEST_RANGES
        digests = []
        for k, side in enumerate(sides):
            # Nothing equals a value that is absent or not finite, so those differ from each other.
            odd = F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))
            row = F.xxhash64("_key", "run_id", "metric", F.col("value").cast("double"), F.when(odd, k).otherwise(-1)).cast("decimal(20,0)")
            digests.append(side.groupBy(F.pmod("_key", F.lit(size)).alias("range")).agg(F.count("*").alias(f"n{k}"), F.sum(row).alias(f"h{k}")))
        off = digests[0].join(digests[1], "range", "full_outer").where("NOT (n0 <=> n1 AND h0 <=> h1)").select("range")
        off = written(off, "ranges")
        sides = [side.join(F.broadcast(off), F.pmod("_key", F.lit(size)) == F.col("range"), "left_semi") for side in sides]
        if off.count() * FEW > DIGEST_RANGES:
            break
    return sides[0].drop("_key"), sides[1].drop("_key")


def metric_differences(computed: DataFrame, supplied: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows of (run_id, metric, computed, supplied) that differ or that one side lacks (J20); a side has each key once.

    Only rows of ranges whose digests differ are joined. Values that are null or not finite on both sides differ.
    """
    ours, theirs = differing_rows(computed, supplied)
    both = ours.select("run_id", "metric", F.col("value").alias("computed")).join(
        theirs.select("run_id", "metric", F.col("value").alias("supplied")), ["run_id", "metric"], "full_outer"
    )
    return both.where(F.col("computed").isNull() | F.col("supplied").isNull() | (F.abs(F.col("computed") - F.col("supplied")) > tolerance))


#: Hashes under one of the next level.
FANOUT = 32


def fingerprints(rows: DataFrame, keys: list[str], group: str) -> DataFrame:
    """(group, rows, fingerprint) of a table's content in the order of keys, whatever its partitions."""
    return ordered_digests(rows, group, keys, FANOUT).withColumnRenamed("digest", "fingerprint")


def details(answers: DataFrame, found: DataFrame, classified: DataFrame) -> DataFrame:
    """A row for each answer with its objects and citations nested, for export.

    Objects of an answer are bounded by the run's objects, citations by its answer's text.
    """
    objects = found.groupBy("run_id", "answer_id").agg(F.array_sort(F.collect_list(F.struct("report_rank", "object_id", "first_position"))).alias("objects"))
    cited = classified.groupBy("run_id", "answer_id").agg(
        F.array_sort(F.collect_list(F.struct("citation_no", "canonical_url", "source_type"))).alias("citations")
    )
    return answers.join(objects, ["run_id", "answer_id"], "left").join(cited, ["run_id", "answer_id"], "left")
