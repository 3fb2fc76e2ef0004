"""Row counts, ranges and null counts of Parquet tables from their footers.

A file's footer holds its number of rows and, per row group, every column's bounds and number
of NULLs.  One job reads the footers of all files (``footers.py``: paths are rows); no data
page is read.  Files whose footers lack a figure that is asked for are read instead, that
column only, so results do not depend on who wrote the files.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.session import materialize
from liftlens.sources.footers import data_files, footers, unreadable
from liftlens.sources.versions import NULL_VALUE, partition_paths

#: types whose bounds in a footer are exact and read back from text
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
_BOUNDS = "map<string, struct<stored: boolean, nulls: bigint, ranged: boolean, min: string, max: string>>"


def file_statistics(spark: SparkSession, files: list[str], columns: Iterable[str] = ()) -> DataFrame:
    """(path, num_rows, bounds) per file; the footers are read once and the figures kept in the shared folder."""
    columns = tuple(columns)
    found = materialize(footers(spark, files, columns), "footers")
    if by_content := unreadable(spark, found):
        found = materialize(footers(spark, files, columns, by_content), "footers")
    return found.select("path", "num_rows", F.from_json("bounds", _BOUNDS).alias("bounds"))


def partition_files(spark: SparkSession, root: str, partition_col: str, values: Iterable | None = None) -> list[str]:
    """Data files of a table, versioned or in plain folders, or of some of its partitions."""
    values = None if values is None else list(values)
    paths = partition_paths(spark, root, partition_col, values)
    if paths is None:
        paths = [root] if values is None else [f"{root}/{partition_col}={NULL_VALUE if v is None else v}" for v in values]
    return data_files(spark, *paths)


def partition_row_counts(spark: SparkSession, root: str, partition_col: str = "shard",
                         values: Iterable | None = None) -> DataFrame:
    """(partition, num_rows) of the partitions that hold rows."""
    files = partition_files(spark, root, partition_col, values)
    if not files:
        return spark.createDataFrame([], f"{partition_col} string, num_rows long")
    folder = F.regexp_extract("path", f"/{partition_col}=([^/]*)/[^/]*$", 1)
    value = F.when(folder != NULL_VALUE, F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
    return (file_statistics(spark, files).groupBy(value.alias(partition_col)).agg(F.sum("num_rows").alias("num_rows"))
            .where(F.col("num_rows") > 0))


def table_statistics(spark: SparkSession, files: list[str], schema: T.StructType, ranges: Iterable[str] = (),
                     nulls: Iterable[str] = ()) -> DataFrame:
    """One row: ``num_rows``, ``min_<c>`` and ``max_<c>`` of ``ranges``, ``nulls_<c>`` of ``nulls``.

    ``schema`` types the columns.  ``ranges`` are integers or dates.  A column that a file does
    not store (a partition column) has no statistics and raises.
    """
    ranges, nulls = tuple(ranges), tuple(nulls)
    if bad := [c for c in ranges if not isinstance(schema[c].dataType, RANGED)]:
        raise ValueError(f"bounds of {bad} are not read from footers")
    asked = tuple(dict.fromkeys((*ranges, *nulls)))

    def figures(n, low, high, missing) -> list:
        out = [n.cast("bigint").alias("num_rows")]
        for c in ranges:
            out += [F.min(low(c)).alias(f"min_{c}"), F.max(high(c)).alias(f"max_{c}")]
        return out + [missing(c).cast("bigint").alias(f"nulls_{c}") for c in nulls]

    def of_rows(df: DataFrame) -> DataFrame:
        return df.agg(*figures(F.count(F.lit(1)), F.col, F.col, lambda c: F.count_if(F.col(c).isNull())))

    if not files:
        return of_rows(spark.createDataFrame([], schema))
    found = file_statistics(spark, files, asked)

    def of(c: str, field: str):
        return F.col("bounds")[c][field]
    absent = F.explode(F.array(*[F.when(~of(c, "stored"), F.lit(c)) for c in asked])) if asked else F.lit(None)
    if missing := found.select("path", absent.alias("c")).where(F.col("c").isNotNull()).first():
        raise ValueError(f"{missing.c} is not stored in {missing.path}")
    known = reduce(lambda a, b: a & b, [of(c, "ranged").isNotNull() for c in ranges] +
                   [of(c, "nulls").isNotNull() for c in nulls], F.lit(True))
    # one path per file without statistics, as many as the listing names at most
    unknown = [r.path for r in found.where(~known).select("path").collect()] if asked else []

    def bound(field: str):
        return lambda c: of(c, field).cast(schema[c].dataType)
    parts = found.where(known).agg(*figures(F.coalesce(F.sum("num_rows"), F.lit(0)), bound("min"), bound("max"),
                                            lambda c: F.coalesce(F.sum(of(c, "nulls")), F.lit(0))))
    if unknown:
        parts = parts.unionByName(of_rows(spark.read.schema(schema).parquet(*unknown)))
    return parts.agg(*figures(F.sum("num_rows"), lambda c: F.col(f"min_{c}"), lambda c: F.col(f"max_{c}"),
                              lambda c: F.sum(f"nulls_{c}")))
