"""Declared schemas of the raw shards, staging, sessions and estimates, and
the schema-drift guard (S7, ``on_schema_change='fail'``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
])

RAW_EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", PARAM_VALUE),
    ]))),
    T.StructField("traffic_source", T.StructType([
        T.StructField("medium", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("name", T.StringType()),
    ])),
    T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
    T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("ecommerce", T.StructType([
        T.StructField("purchase_revenue_in_usd", T.DoubleType())])),
])

# Raw shards as stored: partitioned by ``shard`` (the ``YYYYMMDD`` suffix).
RAW_SHARDS = T.StructType(RAW_EVENT.fields + [T.StructField("shard", T.StringType())])

STAGING = T.StructType([
    T.StructField("event_date_key", T.LongType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_at", T.TimestampNTZType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("ga_session_id", T.LongType()),
    T.StructField("traffic_medium", T.StringType()),
    T.StructField("traffic_source", T.StringType()),
    T.StructField("traffic_campaign", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("purchase_revenue_usd", T.DoubleType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("session_key", T.StringType()),
])

ESTIMATES = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("ate", T.DoubleType()),
    T.StructField("run_at", T.TimestampNTZType()),
    T.StructField("naive_difference", T.DoubleType()),
    T.StructField("n_sessions", T.LongType()),
    T.StructField("n_paid", T.LongType()),
    T.StructField("n_converted", T.LongType()),
    T.StructField("data_start", T.DateType()),
    T.StructField("data_end", T.DateType()),
    T.StructField("load_seq", T.LongType()),
])


class SchemaDriftError(ValueError):
    pass


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def check_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Raise if ``df`` differs from ``declared`` in names, order or types.

    Nullability is not compared (Parquet round trips make everything
    nullable).  Returns ``df`` so it can sit inside a chain.
    """
    if _shape(df.schema) != _shape(declared):
        _drift(_shape(df.schema), declared, "")
        raise SchemaDriftError("schema drift: the order of the columns differs")
    return df


def check_columns(found: T.StructType, declared: T.StructType, what: str = "") -> None:
    """Raise if two schemas differ in names or types of columns, whatever their order."""
    check_fields(_shape(found), declared, what)


def check_fields(found: list[tuple[str, str]], declared: T.StructType, what: str = "") -> None:
    """``check_columns`` for (name, type) pairs."""
    if sorted(found) != sorted(_shape(declared)):
        _drift(found, declared, what)


def _drift(got: list[tuple[str, str]], declared: T.StructType, what: str) -> None:
    want = _shape(declared)
    extra = [c for c in got if c not in want]
    missing = [c for c in want if c not in got]
    if extra or missing:
        raise SchemaDriftError(f"schema drift{what and ' in ' + what}: extra={extra} missing={missing}")
