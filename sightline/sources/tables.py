"""The library's tables, bound to a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Objects of every run: (object_id, role, display_order, alias).
OBJECTS = (
    ("target", "target", 0, "attion"), ("competitor-01", "competitor", 1, "erble"), ("competitor-02", "competitor", 2, "ertion"),
    ("competitor-03", "competitor", 3, "orre")
)
#: Official domains of every run: (object_id, role, display_order, domain, domain_pos).
DOMAINS = (("target", "target", 0, "example.com", 0), ("competitor-01", "competitor", 1, "example.net", 0))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by key over all cores: a small file is read by one task, which would then do all that follows for it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as answers: the source is the run, English ones are generic, ids set the intent."""
    docs = read(spark, sf_dir, "documents")
    intent = F.when(F.col("doc_id") % 3 == 0, "decision").when(F.col("doc_id") % 3 == 1, "comparison").otherwise("recommendation")
    return docs.select(
        F.col("source").alias("run_id"), F.col("doc_id").alias("answer_id"), F.col("doc_id").alias("sequence"), F.col("text").alias("answer_text"),
        F.when(F.col("lang") == "en", "generic").otherwise("branded").alias("question_type"), intent.alias("funnel_intent"),
        F.coalesce(F.trim("text") != "", F.lit(False)).alias("valid"),
    )


def _every_run(runs: DataFrame, rows: tuple, schema: str) -> DataFrame:
    """Fixed rows for each run."""
    names = [x.split()[0] for x in schema.split(", ")]
    each = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return runs.select("run_id", F.explode(each).alias("x")).select("run_id", "x.*")


def runs_of(rows: DataFrame) -> DataFrame:
    return rows.select("run_id").where("run_id is not null").distinct()


def objects(rows: DataFrame) -> DataFrame:
    return _every_run(runs_of(rows), OBJECTS, "object_id string, role string, display_order int, alias string")


def domains(rows: DataFrame) -> DataFrame:
    return _every_run(runs_of(rows), DOMAINS, "object_id string, role string, display_order int, domain string, domain_pos int")


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as citations: four to an answer, runs of ten thousand answers."""
    pages = read(spark, sf_dir, "pages")
    answer = F.floor(F.col("page_id") / 4)
    return pages.select(
        F.concat(F.lit("run"), F.floor(answer / 10_000).cast("string")).alias("run_id"), answer.alias("answer_id"),
        (F.col("page_id") % 4 + 1).cast("int").alias("citation_no"),
        F.format_string("C-%d-%03d", answer, F.col("page_id") % 4 + 1).alias("citation_id"), F.col("url").alias("raw_url"),
        F.lit(None).cast("string").alias("domain_hint"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as samples: a conversation is a question, a turn a repeat; the assistant's turns with text are eligible."""
    turns = read(spark, sf_dir, "conversations")
    said = F.coalesce(F.trim("text") != "", F.lit(False))
    return turns.select(
        F.concat(F.lit("run"), (F.col("conv_id") % 7).cast("string")).alias("run_id"), F.col("conv_id").alias("question_id"),
        F.format_string("%d-r%02d", "conv_id", "turn").alias("sample_id"), F.col("turn").alias("repeat_index"),
        (
            F.coalesce(F.col("role") == "assistant", F.lit(False)) & said
        ).alias("eligible"), F.when(~said, "invalid").when(F.col("role") == "assistant", "success").otherwise("failed").alias("status"), F.col("text").alias("answer_text"),
    )


def sentiment_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as judgements: toxic is negative, good quality positive."""
    labels = read(spark, sf_dir, "labels")
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return labels.select(
        F.col("doc_id").alias("answer_id"), label.alias("label"),
        F.when(label == "negative", -0.7).when(label == "positive", 0.5).otherwise(0.0).alias("score"),
        (0.5 + (F.col("doc_id") % 50) / 100.0).alias("confidence"), (F.col("doc_id") % 2 + 1).cast("int").alias("attempt")
    )
