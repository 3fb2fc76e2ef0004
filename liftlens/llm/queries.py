"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata import table
from .decontaminate import contamination_report
from .html_text import main_text_report
from .lexical import search_report
from .mixing import mix_report
from .oracle import ORACLE  # noqa: F401
from .pii import pii_report
from .quality import quality_report
from .repeats import repeat_report
from .secrets import secret_report
from .simhash import near_duplicate_report
from .topk import top_k_report
from .url_filter import url_report
from .warc import archive_report
from .whitening import whitening_report


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold."""
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every 50th vector."""
    return top_k_report(table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, weak candidates linked within their scope."""
    return secret_report(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return archive_report(table(spark, sf_dir, "pages"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents to target weights takes from each."""
    return mix_report(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii_report(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text_report(table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a repeated 20-word window covers."""
    return repeat_report(table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return url_report(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on up to 32 whitened components."""
    return whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_topk, op3_secret_scan, op4_warc, op5_mix, op6_pii, op7_simhash, op8_html_text,
    op9_decontaminate, op10_repeats, op11_lexical, op12_url_filter, op13_whitening)}
