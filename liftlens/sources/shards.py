"""Daily shards: landing, reading, incremental partition replace.

Raw shards (``shard=YYYYMMDD``) and staging (``event_date_key``) are versioned tables
(``versions.py``): re-landing or re-loading days writes them beside the old ones and then
replaces all of them in one step, days that have become empty included; every other day
stays untouched – the Spark form of ``insert_overwrite`` / copy-job partition swaps.  Raw
shards that somebody else lands as plain ``shard=YYYYMMDD`` folders are read as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.operators.flatten import STG_COLUMNS, flatten_events
from liftlens.schema import RAW_EVENT, RAW_SHARDS, STAGING, check_columns, check_fields, check_schema
from liftlens.sources.footers import data_files, file_schemas
from liftlens.sources.versions import partition_paths, publish, read_table, stage, table_exists

# The declared integer partition range of the reference window
# (start inclusive, end exclusive, step 1).
REFERENCE_RANGE = (20201101, 20210201)

#: files_per_day: a day gets as many files as its bytes ask for / the partitions of the source as they are
BY_BYTES, AS_IS = None, 0


def replace_partitions(df: DataFrame, path: str, partition_col: str, values=None, dynamic: bool = True) -> None:
    """Replace the partitions that ``df`` holds, and those of ``values``, in one step; others stay.

    Partitions of ``values`` without a row in ``df`` become empty, so a day that has lost its
    rows loses them here too.  Without ``dynamic`` the whole table is replaced.
    """
    publish(df.sparkSession, stage(df, path, partition_col), values, full=not dynamic)


def land_shards(raw: DataFrame, root: str, days: list[str] | None = None,
                files_per_day: int | None = BY_BYTES) -> None:
    """S3: land raw events as daily shards; re-landing a day replaces that day, an empty one included.

    ``raw`` must have the declared raw-event columns, no more and no fewer (S7);
    ``shard`` is derived from ``event_date``.  By default a day gets as many files as its
    bytes ask for: Spark brings the rows of a day together and splits or joins them to tasks
    of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so neither a large day nor many
    small ones need a setting.  ``files_per_day`` fixes an upper bound instead; ``AS_IS``
    writes the source's own partitions, for sources that are clustered by day.
    """
    check_columns(raw.schema, RAW_EVENT, "the raw events")
    df = raw.select(*RAW_EVENT.fieldNames(), F.col("event_date").alias("shard"))
    if days is not None:
        df = df.where(F.col("shard").isin(list(days)))
    if files_per_day is BY_BYTES:
        df = df.hint("rebalance", "shard")
    elif files_per_day:
        salt = F.pmod(F.xxhash64("event_id", "event_timestamp", "user_pseudo_id"), F.lit(files_per_day))
        df = df.repartition(F.col("shard"), salt)
    replace_partitions(df, root, "shard", days)


def read_shards(spark: SparkSession, root: str, ds: str | list[str] | None = None) -> DataFrame:
    """All shards as one table, or one/several days via partition pruning.

    ``ds`` empty or None means every shard (the reference's empty ``ds_nodash``).
    """
    days = [ds] if isinstance(ds, str) else list(ds) if ds else None
    return read_table(spark, root, "shard", RAW_SHARDS, days)


def shard_row_counts(shards: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Rows per shard (one job for all requested days)."""
    if days is not None:
        shards = shards.where(F.col("shard").isin(list(days)))
    return shards.groupBy("shard").agg(F.count(F.lit(1)).alias("num_rows"))


def split_partition_range(stg: DataFrame, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """Rows inside ``[start, end)`` of the declared key range, and the rejects."""
    key = F.col("event_date_key")
    inside = (key >= start) & (key < end)
    return stg.where(inside), stg.where(~inside | key.isNull())


def shard_days(spark: SparkSession, root: str) -> list[str]:
    """Days that are landed below ``root`` (one row per day)."""
    return sorted(r[0] for r in read_shards(spark, root).select("shard").distinct().collect() if r[0] is not None)


def check_shards(spark: SparkSession, root: str, days: list[str] | None = None) -> None:
    """Every file of the given days holds the declared raw columns, no more and no fewer."""
    paths = partition_paths(spark, root, "shard", days)
    if paths is None:
        paths = [root] if days is None else [f"{root}/shard={day}" for day in days if day is not None]
    files = data_files(spark, *paths)
    for fields, n, example in file_schemas(spark, files) if files else ():
        day = example.rsplit("/shard=", 1)[-1].split("/", 1)[0]
        check_fields(fields, RAW_EVENT, f"shard {day} ({n} files like {example})")


def load_staging(spark: SparkSession, raw_root: str, stg_root: str,
                 days: list[str] | None = None, key_range: tuple[int, int] | None = None,
                 full_refresh: bool = False, strict: bool = True, rejects_root: str | None = None) -> DataFrame:
    """Flatten the given shards and replace their staging partitions.

    * ``days`` – shards to (re)load; None = all shards.  Several days go in one
      write (a backfill is one job, same result as a day-by-day loop).
    * ``key_range`` – declared partition range; rows outside go to ``rejects_root``
      (default: beside the staging table), replaced by day like staging itself, and
      are returned.
    * ``full_refresh`` – static overwrite: the whole staging table is replaced.
    * shards of which any file differs from the declared columns, and a staging table
      that was written with other columns, raise before anything is written.
    * rejects and staging are written first and then made visible, each in one step; a load
      that dies on the way leaves the tables as they were.
    """
    check_shards(spark, raw_root, days)
    stg = flatten_events(read_shards(spark, raw_root, days), strict=strict)
    check_schema(stg, STAGING)
    if not full_refresh and (written := _written_schema(spark, stg_root)) is not None:
        check_columns(written, stg.drop("event_date_key").schema, "the written staging table")
    keys = None if days is None else [int(d) for d in days if d is not None]
    out = None
    if key_range is not None:
        stg, out = split_partition_range(stg, *key_range)
        rejects_root = rejects_root or f"{stg_root}_rejects"
        out = stage(out, rejects_root, "event_date_key")
    load = stage(stg, stg_root, "event_date_key")
    if out is not None:
        publish(spark, out, keys, full_refresh)
    publish(spark, load, keys, full_refresh)
    return stg.limit(0) if out is None else read_rejects(spark, rejects_root, keys)


def _written_schema(spark: SparkSession, stg_root: str):
    """Columns of the written staging table without its partition columns; None where it holds nothing."""
    paths = partition_paths(spark, stg_root, "event_date_key")
    if paths is None:
        return spark.read.parquet(stg_root).drop("event_date_key").schema if table_exists(spark, stg_root) else None
    return spark.read.parquet(paths[-1]).schema if paths else None


def read_rejects(spark: SparkSession, rejects_root: str, keys: list[int] | None = None) -> DataFrame:
    """Rows outside the declared range, of the given days or of all."""
    if not table_exists(spark, rejects_root):
        return spark.createDataFrame([], STAGING)
    values = None if keys is None else [*keys, None]
    return read_table(spark, rejects_root, "event_date_key", STAGING, values).select(*STG_COLUMNS)


def read_staging(spark: SparkSession, stg_root: str, keys: list[int] | None = None) -> DataFrame:
    """Staging table as declared (partition column typed bigint, declared order), or some of its days."""
    return read_table(spark, stg_root, "event_date_key", STAGING, keys).select(*STG_COLUMNS)


def backfill(spark: SparkSession, raw_root: str, stg_root: str, days: list[str],
             one_job: bool = True, **kw) -> None:
    """Load an ordered range of days; one write by default, or day by day."""
    if one_job:
        load_staging(spark, raw_root, stg_root, days=list(days), **kw)
        return
    for d in sorted(days):
        load_staging(spark, raw_root, stg_root, days=[d], **kw)


def write_table(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Full rebuild of a table (static overwrite)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)
