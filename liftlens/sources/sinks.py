"""Estimate sink (S11) and table reads for the pipeline's outputs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.operators.causal.results import ESTIMATE_COLUMNS
from liftlens.operators.reports import LOAD_SEQ
from liftlens.schema import ESTIMATES, check_schema


def write_estimates(estimates: DataFrame, path: str, mode: str = "truncate") -> None:
    """Write estimate rows with the declared schema, as computed.

    ``truncate`` replaces the table (the reference's behaviour: history keeps
    one run); ``append`` keeps every run so the latest-per-method view has
    something to choose from.  Each load numbers its rows one higher than the
    table's last, so a repeated run of one day is told from the first.
    """
    if mode not in ("truncate", "append"):
        raise ValueError("mode must be 'truncate' or 'append'")
    number = 1 + (last_load(estimates.sparkSession, path) if mode == "append" else 0)
    rows = estimates.select(*ESTIMATE_COLUMNS, F.lit(number).cast("long").alias(LOAD_SEQ))
    check_schema(rows, ESTIMATES)
    rows.write.mode("overwrite" if mode == "truncate" else "append").parquet(path)


def last_load(spark: SparkSession, path: str) -> int:
    try:
        return read_estimates(spark, path).agg(F.max(LOAD_SEQ)).first()[0] or 0
    except AnalysisException:
        return 0


def read_estimates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ESTIMATES).parquet(path)
