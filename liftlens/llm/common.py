"""Helpers shared by the operators: array scans in SQL, Arrow maps over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(values: Column, combine: Callable[[Column, Column], Column], neutral: Column) -> Column:
    """Inclusive prefix scan of an array column with an associative ``combine``.

    Doubling strides (1, 2, 4, ...): n log n element operations, no shuffle and
    no lambda that copies a growing array per element.
    """
    n = F.size(values)
    empty = F.array().cast("array<int>")
    strides = F.when(n > 1, F.transform(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int")),
                                        lambda j: F.pow(F.lit(2), j).cast("int"))).otherwise(empty)

    def step(acc: Column, stride: Column) -> Column:
        shifted = F.slice(F.concat(F.array_repeat(neutral, stride), acc), 1, F.size(acc))
        return F.zip_with(acc, shifted, combine)

    return F.aggregate(strides, values, step)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` without columns called ``names`` (whatever their case), and a function that
    selects the columns of ``df`` from a result, with their own names and order."""
    taken = {n.lower() for n in names}
    moved = {c: f"__aside_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{moved[c]}`").alias(c) if c in moved else F.col(f"`{c}`") for c in df.columns])

    return df.withColumnsRenamed(moved), restore


def map_text(df: DataFrame, text_col: str, fields: Sequence[T.StructField],
             make: Callable[[], Callable[..., Sequence[pa.Array]]],
             keep: Iterable[str] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Append columns computed from one text column, one Arrow batch at a time.

    ``make`` runs once per task and returns ``texts, *extra -> arrays`` (one array per
    field).  ``extra`` names further input columns; ``keep`` names the input columns to carry along (default all); an
    input column named like a new field is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    cols = list(dict.fromkeys([*kept, text_col, *extra]))
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in by_bytes(batch, text_col):
                arrays = [part.column(c) for c in kept]
                arrays += list(fn(*(part.column(c).to_pylist() for c in (text_col, *extra))))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(*cols).mapInArrow(run, schema)


def by_bytes(batch: pa.RecordBatch, col: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``limit`` bytes of ``col`` (one row at least),
    so that what Python makes of long texts stays bounded."""
    n = batch.num_rows
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(col)), 0)).astype(np.int64)
    slot = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
