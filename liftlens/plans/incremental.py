"""The session mart kept current (X2): only what a load touches is read and replaced.

Per-day session partials and the mart are versioned tables cut into ``buckets`` by a hash of
the session key: partials by (day, bucket), the mart by bucket.  All days of a session are in
one bucket.  A load of some days

1. replaces the partials of those days,
2. merges the partials of all days, but only in buckets that hold a session of the loaded
   days, now or before the load (a session may have lost its only event),
3. replaces those buckets of the mart in one step.

So a day costs its own events plus the touched buckets' partials (one row per day and
session), whatever the length of the history.  A run that dies between 1 and 3 leaves the
mart as it was; the same days run again mend it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.operators.sessions import SESSION_COLUMNS, merge_partials, session_partials
from liftlens.schema import STAGING
from liftlens.sources.versions import current, publish, read_table, stage

BUCKETS = 64
PART = "part"
NO_DAY = "none"


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("session_key"), F.lit(buckets))


def _partials_schema(spark: SparkSession) -> T.StructType:
    fields = session_partials(spark.createDataFrame([], STAGING)).schema.fields
    return T.StructType([*fields, T.StructField(PART, T.StringType())])


def _mart_schema(spark: SparkSession) -> T.StructType:
    fields = merge_partials(spark.createDataFrame([], _partials_schema(spark))).schema.fields
    return T.StructType([*fields, T.StructField("bucket", T.LongType())])


def _day(part: str) -> str:
    return part.rsplit("-", 1)[0]


def _bucket(part: str) -> int:
    return int(part.rsplit("-", 1)[1])


def stage_partials(stg: DataFrame, root: str, buckets: int = BUCKETS):
    """Partials of staged events as a new, not yet visible load of the partials table."""
    part = F.concat_ws("-", F.coalesce(F.col("event_date_key").cast("string"), F.lit(NO_DAY)), bucket_of(buckets).cast("string"))
    # the rows of a (day, bucket) come together, split only where their bytes ask for it
    return stage(session_partials(stg).withColumn(PART, part).hint("rebalance", PART), root, PART)


def read_partials(spark: SparkSession, root: str, in_buckets: Iterable[int] | None = None) -> DataFrame:
    """Partials of all days, or of some buckets: other buckets' folders are not listed."""
    held = current(spark, root) or {}
    parts = None if in_buckets is None else [p for p in held if _bucket(p) in set(in_buckets)]
    return read_table(spark, root, PART, _partials_schema(spark), parts).drop(PART)


def update_sessions(stg: DataFrame, partials_root: str, mart_root: str, days: Iterable[int] | None = None,
                    buckets: int = BUCKETS) -> set[int]:
    """Bring partials and mart up to date with ``stg``, the staged events of ``days`` (None: of all days).

    Returns the buckets that were replaced.  ``buckets`` belongs to the table: it must not
    change between loads.
    """
    spark = stg.sparkSession
    load = stage_partials(stg, partials_root, buckets)
    held = current(spark, partials_root) or {}
    wanted = None if days is None else {str(d) for d in days}
    replaced = [p for p in held if wanted is None or _day(p) in wanted]
    touched = {_bucket(p) for p in (*load.values, *replaced)}
    publish(spark, load, replaced)
    mart = merge_partials(read_partials(spark, partials_root, touched)).withColumn("bucket", bucket_of(buckets))
    publish(spark, stage(mart.hint("rebalance", "bucket"), mart_root, "bucket"), sorted(touched))
    return touched


def read_sessions(spark: SparkSession, mart_root: str) -> DataFrame:
    """The session mart."""
    return read_table(spark, mart_root, "bucket", _mart_schema(spark)).select(*SESSION_COLUMNS)
