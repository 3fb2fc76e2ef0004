"""Corpus pipeline: quality, near-duplicates, benchmark decontamination, secrets, mix.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all documents that its
predecessor kept.  ``run`` writes each result as Parquet below the shared folder and reads
it again, so a lost executor costs one stage at most and plans stay short.

* ``quality``          documents that score below 0.3 go
* ``near_duplicates``  one document of each group of fingerprints stays (smallest id)
* ``decontaminate``    documents that hold a benchmark window go
* ``secret_scan``      every secret span is masked; the documents stay
* ``mix``              documents that the mix takes stay, with the copies and words it takes

All but the last return the columns of ``documents``.  Null and empty texts are documents
like others (the operators define what they give); further columns pass through; empty
tables give empty results.  ``n_chars`` follows the text where masking changed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm import decontaminate as contamination
from liftlens.llm import mixing, quality as scoring, secrets, simhash
from liftlens.session import materialize, ship_package
from liftlens.sources.testdata import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship_package(spark)
    return scoring.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship_package(spark)
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    ship_package(spark)
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="document")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redact_secrets(docs).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, copies and words taken."""
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    return mixing.mix_sources(sized).where(F.col("copies") > 0)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secret_scan", secret_scan), ("mix", mix)]

#: A learned classifier decides first: SQL cannot express it.  Tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
