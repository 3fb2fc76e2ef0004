"""Staging and mart bucketed by the session key (A1, Q2, Q4).

Rows are dealt to ``buckets`` by a hash of the session key when the table is written.  The
session rollup, the uniqueness test of the key and the relationship test between two tables of
the same number of buckets then need no exchange: rows of a session are in one bucket already.
The table is external: its files are below the shared folder, its entry is in the catalog.

Writing brings a bucket's rows to one task, so a bucket is one file; a session that holds a
large part of all events makes its bucket that much larger, for the writer (which streams rows)
and for every reader.  ``gather=False`` lets each task write its own rows, one file per task and
bucket: no shuffle and no hot writer, more files.  Readers are the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.session import fresh_dir

KEY = "session_key"


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str = KEY, gather: bool = True) -> DataFrame:
    """Write ``df`` as a new table of ``buckets`` buckets and return the table."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    rows = df.repartition(buckets, F.col(key)) if gather else df
    (rows.write.bucketBy(buckets, key).option("path", fresh_dir(spark, f"bucketed-{name}"))
     .format("parquet").saveAsTable(table))
    return spark.table(table)
