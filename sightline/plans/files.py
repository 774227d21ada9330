"""Queries over JSON files that Spark writes from rows of the tables and reads back, large ones by byte ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bank
from ..session import shared_folder
from ..sources import files, ingest
from .banks import _documents
from .raw import _samples
from .register import ORACLE, query

#: Where a document's run or bank stands in its path.
FOLDER = r"/id=([^/]+)/[^/]+$"
#: Conversations of all seven runs whose samples make up a document of each run.
CONVERSATIONS = 7000


def _folder(rows: DataFrame) -> str:
    """Write each row (id, body) to a file of its own, in a folder for each id."""
    path = f"{shared_folder(rows.sparkSession)}/documents-{uuid.uuid4().hex}"
    rows.select("id", "body").write.partitionBy("id").option("maxRecordsPerFile", 1).text(path)
    return path


@query(ORACLE["crawl_samples"])
def file_crawl_samples(spark, sf_dir):
    """Crawls from files of a thousand conversations each, cut by byte ranges."""
    samples, asked = _samples(spark, sf_dir)
    listed = lambda items: F.array_join(F.transform(items, lambda x: F.to_json(x)), ", ")
    merged = samples.groupBy("run_id", F.floor(F.col("conv_id") / CONVERSATIONS)).agg(
        listed(F.collect_list("sample")).alias("samples"), listed(F.flatten(F.collect_list("plan"))).alias("plan")
    )
    body = F.concat(F.lit('{"samples": ['), "samples", F.lit('], "plan": ['), "plan", F.lit('], "note": {"by": "crawler"}}'))
    crawls, errors = files.read_crawls(spark, _folder(merged.select(F.col("run_id").alias("id"), body.alias("body"))), name=FOLDER)
    found = ingest.import_crawl(crawls, asked).select("run_id", "sample_id", "question_match", F.coalesce("error_code", F.lit("OK")).alias("code"))
    # No file is broken; one that were would show as a row that the samples do not have.
    broken = errors.select(F.lit(None).cast("string").alias("run_id"), F.col("path").alias("sample_id"), F.lit(None).cast("string").alias("question_match"), F.col("error").alias("code"))
    return found.unionByName(broken)


@query(ORACLE["bank_rivals"])
def file_bank_rivals(spark, sf_dir):
    """Question banks from files, one a bank, their questions cut out of the bytes."""
    # A bank's name goes through its file's, which is part of a URI.
    named = F.concat(F.replace(F.col("bank_id"), F.lit("#"), F.lit("_")), F.lit(".json"))
    banks, _ = files.read_banks(spark, files.write_files(_documents(spark, sf_dir).select(named.alias("name"), "body")))
    found = bank.rival_coverage(banks, bank.row_flags(banks))
    return found.select(F.replace(F.col("bank_id"), F.lit("_"), F.lit("#")).alias("bank_id"), "name", "all_questions", "solo", "multi")
