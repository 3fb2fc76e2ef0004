"""Flattening raw nested events to the staging grain (operators F1-F6).

One narrow projection over the raw shards: nested-struct fields are selected
by path (Parquet nested-schema pruning reads only those leaves), the session
id comes from a higher-order ``filter`` over ``event_params`` and rows without
a session id are dropped.  No shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.functions.params import param_value
from liftlens.functions.timeconv import ntz_from_micros

# Output columns of the staging model, in order; ``event_id`` is our tie key.
STG_COLUMNS = (
    "event_date_key", "event_date", "event_at", "event_name", "user_pseudo_id",
    "ga_session_id", "traffic_medium", "traffic_source", "traffic_campaign",
    "device_category", "geo_country", "purchase_revenue_usd", "event_id", "session_key",
)


def _typed(raw: DataFrame, strict: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    tie = F.col("event_id") if "event_id" in raw.columns else F.col("event_timestamp")
    return raw.select(
        F.col("event_date").cast("bigint").alias("event_date_key"),
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        ntz_from_micros(F.col("event_timestamp")).alias("event_at"),
        "event_name",
        "user_pseudo_id",
        param_value("event_params", "ga_session_id", "int_value", strict).alias("ga_session_id"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("geo_country"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
        tie.cast("bigint").alias("event_id"),
        *keep,
    )


def flatten_events(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staging events: typed, flattened, with ``session_key``; sessionless rows dropped.

    ``keep`` names raw columns that are carried along unchanged.

    ``session_key`` uses ``concat`` (NULL in, NULL out), so a NULL user gives a
    NULL key exactly as in the reference; such rows surface in the quality
    report rather than being silently merged.
    """
    typed = _typed(raw, strict, keep).where(F.col("ga_session_id").isNotNull())
    key = F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("ga_session_id").cast("string"))
    return typed.select(*[c for c in STG_COLUMNS if c != "session_key"], key.alias("session_key"), *keep)


def events_without_session(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The rows ``flatten_events`` drops (no ``ga_session_id`` parameter)."""
    return _typed(raw, strict).where(F.col("ga_session_id").isNull())


def lookup_params(raw: DataFrame, keys: dict[str, tuple[str, str]],
                  strict: bool = True) -> DataFrame:
    """Several ``event_params`` lookups in one pass (``{alias: (key, field)}``)."""
    cols = [param_value("event_params", key, field, strict).alias(alias)
            for alias, (key, field) in keys.items()]
    return raw.select("event_id", *cols)
