"""Schemas of Parquet files as their footers say (S7), read by a Spark job, no data pages.

A folder's schema as Spark reports it is that of one file; a file that lacks a column reads
as NULL and a further column is passed over.  So every file is asked: paths are rows, tasks
read the footers, and one row per distinct schema comes back.  The same job gives row counts,
bounds and null counts of columns from the row groups' statistics (``statistics.py``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_PER_TASK = 64
_FOOTER = "path string, fields string, num_rows long, bounds string"


def data_files(spark: SparkSession, *paths: str) -> list[str]:
    """Parquet files below the paths (a listing, nothing is read)."""
    def listed(*some: str) -> list[str]:
        return spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(*some).inputFiles()
    try:
        return sorted(listed(*paths)) if paths else []
    except AnalysisException:      # a folder is missing: ask for each
        if len(paths) == 1:
            return []
        return sorted(f for path in paths for f in data_files(spark, path))


def _open(path: str):
    if path.startswith("file:"):
        return pq.ParquetFile(unquote("/" + path[5:].lstrip("/")))
    if "://" not in path:
        return pq.ParquetFile(unquote(path))
    store, inner = pafs.FileSystem.from_uri(path)
    return pq.ParquetFile(store.open_input_file(inner))


def _describe(path: str, file: pq.ParquetFile, columns: tuple[str, ...]) -> tuple:
    from pyspark.sql.pandas.types import from_arrow_schema
    found = from_arrow_schema(file.schema_arrow)
    names = [file.metadata.schema.column(i).path for i in range(file.metadata.num_columns)]
    bounds = {}
    for c in columns:
        if c not in names:
            bounds[c] = {"stored": False}
            continue
        at = names.index(c)
        stats = [file.metadata.row_group(g).column(at).statistics for g in range(file.metadata.num_row_groups)]
        if all(s is not None and s.has_null_count for s in stats):
            bounds[c] = {"stored": True, "nulls": sum(s.null_count for s in stats)}
            if all(s.has_min_max or s.num_values == 0 for s in stats):
                held = [s for s in stats if s.num_values]
                bounds[c] |= {"ranged": True, "min": str(min(s.min for s in held)) if held else None,
                              "max": str(max(s.max for s in held)) if held else None}
    return (path, json.dumps(sorted((f.name, f.dataType.simpleString()) for f in found.fields)), file.metadata.num_rows,
            json.dumps(bounds))


def footers(spark: SparkSession, files: list[str], columns: tuple[str, ...] = (), by_content: list[str] = ()) -> DataFrame:
    """(path, fields, num_rows, bounds) per file: ``fields`` is a JSON list of (name, type) in order of
    names, ``bounds`` a JSON object column -> {stored, nulls, ranged, min, max} for ``columns``: ``nulls``
    where all row groups count them, ``ranged`` where all have bounds (null ones: no value but NULL).

    Files whose store the tasks cannot open have null ``fields``; named in ``by_content`` they
    are read through Spark's own ``binaryFile`` source.
    """
    columns = tuple(columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    rows.append(_describe(path, _open(path), columns))
                except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
                    rows.append((path, None, None, None))
            yield pd.DataFrame(rows, columns=["path", "fields", "num_rows", "bounds"]).astype({"num_rows": "Int64"})

    def read_content(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_describe(p, pq.ParquetFile(pa.BufferReader(c)), columns) for p, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame(rows, columns=["path", "fields", "num_rows", "bounds"])

    def of(some: list[str]) -> DataFrame:
        tasks = max(-(-len(some) // FILES_PER_TASK), min(len(some), spark.sparkContext.defaultParallelism))
        return spark.createDataFrame(pa.table({"path": pa.array(some, pa.string())})).repartition(max(tasks, 1))

    found = of(files).mapInPandas(read, _FOOTER)
    if not by_content:
        return found
    content = spark.read.format("binaryFile").load(by_content).select("path", "content")
    rest = [f for f in files if f not in set(by_content)]
    return of(rest).mapInPandas(read, _FOOTER).unionByName(content.mapInPandas(read_content, _FOOTER))


def unreadable(spark: SparkSession, found: DataFrame) -> list[str]:
    """Files whose store only Spark can open."""
    return [r.path for r in found.where(F.col("fields").isNull()).select("path").collect()]


def file_schemas(spark: SparkSession, files: list[str]) -> list[tuple[list[tuple[str, str]], int, str]]:
    """(fields, number of files, one file) for every distinct schema among the files."""
    def grouped(by_content: list[str]):
        per = footers(spark, files, by_content=by_content).groupBy("fields")
        return per.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).collect()
    rows = grouped([])
    if any(r.fields is None for r in rows):
        rows = grouped(unreadable(spark, footers(spark, files)))
    return [([tuple(x) for x in json.loads(r.fields)], r.n, r.path) for r in sorted(rows, key=lambda r: r.path)]
