"""A corpus pipeline of five stages; each works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import langid, packing, pii, quality, simhash
from sightline.llm.common import table, written
from sightline.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Mean probability under which no language is believed.
LEAST_LANGUAGE = 0.4


def _documents(kept: DataFrame) -> DataFrame:
    return kept.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the network believes, go."""
    found = langid.identify(docs, langid.train(docs), keep=["text", "lang", "source", "n_chars"])
    return _documents(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below its threshold go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _documents(quality.score(docs, model, keep=["text", "lang", "source", "n_chars"]).where("predicted = 1"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that with the smallest id, null ids last; of equal ids that with the smallest hash."""
    # The hash tells rows apart whatever their ids; rows that share it are copies in every column.
    hashed = _documents(docs).withColumn("row_hash", F.concat_ws(" ", F.md5("text"), F.xxhash64(*COLUMNS).cast("string")))
    found = simhash.near_groups(hashed, keep=["row_hash"])
    kept = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash"))["row_hash"].alias("row_hash")
    ).select("row_hash")
    return _documents(hashed.join(kept, "row_hash", "left_semi").dropDuplicates(["row_hash"]))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; no document goes."""
    return pii.redact_texts(_documents(docs), pii.train(docs)).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language", language), ("quality", good_quality), ("simhash", distinct_documents), ("pii", without_personal_data), ("packing", packed)]

#: SQL cannot express a network, a rule ensemble or first-fit decreasing; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage but the last is written once and read by the next, which reads its documents several times."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
