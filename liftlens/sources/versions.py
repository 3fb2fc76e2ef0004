"""Tables whose partitions are replaced in one step.

A table is a folder with two parts:

* ``loads/load=<id>/<column>=<value>/`` – every load writes its own, new folder,
* ``versions/version=<n>/`` – one small file per load, written last: which load holds a
  partition's rows from now on (none: the partition is empty).

Readers resolve the newest entry of every partition and read those folders only.  So a load
of many partitions appears as a whole or not at all: one that dies before its version file
leaves the old state, and folders that no version names are never read.  Nothing is
overwritten, which also holds on stores without atomic folder renames.  Two loads at a time
would take the same version number; the second one fails instead of hiding the first.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = T.StructType([T.StructField("value", T.StringType()), T.StructField("load", T.StringType()),
                    T.StructField("version", T.LongType())])
EVERYTHING = "*"                              # a version entry that empties all partitions before it
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"     # folder name of a null partition value


class Staged(NamedTuple):
    """A load that is written and not yet visible."""

    root: str
    load: str
    values: tuple[str, ...]


def log(spark: SparkSession, root: str) -> list | None:
    """All version entries (one per replaced partition); None where the folder is no such table."""
    try:
        return spark.read.schema(LOG).parquet(f"{root}/versions").collect()
    except AnalysisException:
        return None


def current(spark: SparkSession, root: str) -> dict[str, str] | None:
    """The load that holds each non-empty partition; None where ``root`` is no versioned table."""
    entries = log(spark, root)
    if entries is None:
        return None
    since = max((e.version for e in entries if e.value == EVERYTHING), default=0)
    held: dict[str, str | None] = {}
    for e in sorted(entries, key=lambda e: e.version):
        if e.version >= since and e.value != EVERYTHING:
            held[e.value] = e.load
    return {v: load for v, load in held.items() if load}


def stage(df: DataFrame, root: str, partition_col: str) -> Staged:
    """Write ``df`` as a new load of the table; readers do not see it yet."""
    spark, load = df.sparkSession, f"l{uuid.uuid4().hex[:12]}"
    path = f"{root}/loads/load={load}"
    df.write.partitionBy(partition_col).parquet(path)
    # the written folders tell which partitions the load holds: ``df`` is not computed again
    files = spark.read.schema(df.schema).parquet(path).inputFiles()
    mark = f"/{partition_col}="
    values = {unquote(f.rsplit(mark, 1)[1].split("/", 1)[0]) for f in files if mark in f}
    return Staged(root, load, tuple(sorted(values)))


def publish(spark: SparkSession, staged: Staged, values: Iterable[str] | None = None, full: bool = False) -> int:
    """Make a staged load visible: its partitions replace the table's, in one step.

    ``values`` names further partitions that the load replaces; those without a row become
    empty.  ``full`` replaces the whole table.  Returns the version's number.
    """
    version = max((e.version for e in log(spark, staged.root) or ()), default=0) + 1
    entries = {str(v): None for v in values or ()} | {v: staged.load for v in staged.values}
    rows = ([(EVERYTHING, None)] if full else []) + sorted(entries.items())
    names, loads = zip(*rows) if rows else ((), ())
    entry = spark.createDataFrame(pa.table({"value": pa.array(names, pa.string()), "load": pa.array(loads, pa.string())}))
    # one file, and an error where the number is taken
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{staged.root}/versions/version={version}")
    return version


def table_exists(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` holds a versioned table or plain Parquet files."""
    if log(spark, root) is not None:
        return True
    try:
        spark.read.parquet(root).schema
    except AnalysisException:
        return False
    return True


def partition_paths(spark: SparkSession, root: str, partition_col: str, values: Iterable | None = None) -> list[str] | None:
    """Folders of the partitions named (default: all) that hold rows; None where the table has plain folders."""
    held = current(spark, root)
    if held is None:
        return None
    wanted = None if values is None else {NULL_VALUE if v is None else str(v) for v in values}
    return [f"{root}/loads/load={load}/{partition_col}={v}" for v, load in sorted(held.items())
            if wanted is None or v in wanted]


def read_table(spark: SparkSession, root: str, partition_col: str, schema: T.StructType,
               values: Iterable | None = None) -> DataFrame:
    """The table's rows, or those of some partitions: only their folders are listed and read."""
    values = None if values is None else list(values)
    paths = partition_paths(spark, root, partition_col, values)
    if paths is None:
        df = spark.read.schema(schema).parquet(root)
    elif not paths:
        return spark.createDataFrame([], schema)
    else:
        with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
        df = spark.read.schema(with_load).option("basePath", f"{root}/loads").parquet(*paths).drop("load")
    if values is not None:
        held = F.col(partition_col).isin([v for v in values if v is not None])
        df = df.where(held | F.col(partition_col).isNull() if None in values else held)
    return df.select(*schema.fieldNames())
