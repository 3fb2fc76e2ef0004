"""Session rollup (operators A1-A7) and its mergeable per-day form.

One ``groupBy`` on the session key: map-side partial aggregation first, so a
session with millions of events (one hot key) reaches the final aggregate as
one partial row per map task, never as one giant group.

First touch (A5) is the earliest non-NULL value per column, independently for
medium, source and campaign; ties on ``event_at`` are broken by ``event_id``.
``any_value`` of the reference is made deterministic as ``min``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.channels import is_paid_medium
from liftlens.functions.money import money_sum

SESSION_COLUMNS = (
    "session_key", "user_pseudo_id", "session_date_key", "session_date", "session_start_at",
    "is_paid", "first_touch_medium", "first_touch_source", "first_touch_campaign",
    "converted", "session_revenue_usd", "device_category", "geo_country", "is_new_user",
)
SESSION_KEYS = ("session_key", "user_pseudo_id")
TOUCH_COLUMNS = {"first_touch_medium": "traffic_medium",
                 "first_touch_source": "traffic_source",
                 "first_touch_campaign": "traffic_campaign"}


def _tie() -> Column:
    return F.struct("event_at", "event_id")


def first_non_null(c: str) -> Column:
    """Value of ``c`` on the earliest event where it is not NULL (NULL if none)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _tie()))


def sessionize(stg: DataFrame) -> DataFrame:
    """``fct_sessions``: one row per (session_key, user_pseudo_id)."""
    aggs = [
        F.min("event_date_key").alias("session_date_key"),
        F.min("event_date").alias("session_date"),
        F.min("event_at").alias("session_start_at"),
        F.bool_or(is_paid_medium("traffic_medium")).alias("is_paid"),
        *[first_non_null(src).alias(dst) for dst, src in TOUCH_COLUMNS.items()],
        F.bool_or(F.col("event_name") == "purchase").alias("converted"),
        money_sum("purchase_revenue_usd").cast("double").alias("session_revenue_usd"),
        F.min("device_category").alias("device_category"),
        F.min("geo_country").alias("geo_country"),
        F.bool_or(F.col("event_name") == "first_visit").alias("is_new_user"),
    ]
    return stg.groupBy(*SESSION_KEYS).agg(*aggs).select(*SESSION_COLUMNS)


# --- X2: per-day partials that merge into the same sessions ----------------

def session_partials(stg: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per (event_date_key, session) partial state; every field is mergeable.  ``keys`` go with the day.

    Stored per day, so a late or re-delivered day only rewrites its own
    partials; the merge then never rescans raw events of other days.
    """
    def touch(src: str) -> Column:
        return F.min(F.when(F.col(src).isNotNull(),
                            F.struct("event_at", "event_id", F.col(src).alias("v"))))
    return stg.groupBy(*keys, "event_date_key", *SESSION_KEYS).agg(
        F.min("event_date").alias("p_date"),
        F.min("event_at").alias("p_start"),
        F.bool_or(is_paid_medium("traffic_medium")).alias("p_paid"),
        *[touch(src).alias(f"p_{dst}") for dst, src in TOUCH_COLUMNS.items()],
        F.bool_or(F.col("event_name") == "purchase").alias("p_converted"),
        money_sum("purchase_revenue_usd").alias("p_revenue"),
        F.min("device_category").alias("p_device"),
        F.min("geo_country").alias("p_geo"),
        F.bool_or(F.col("event_name") == "first_visit").alias("p_new_user"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Merge per-day partials into sessions; equals ``sessionize`` of all days."""
    merged = partials.groupBy(*SESSION_KEYS).agg(
        F.min("event_date_key").cast("bigint").alias("session_date_key"),
        F.min("p_date").alias("session_date"),
        F.min("p_start").alias("session_start_at"),
        F.bool_or("p_paid").alias("is_paid"),
        *[F.min(f"p_{dst}").alias(f"m_{dst}") for dst in TOUCH_COLUMNS],
        F.bool_or("p_converted").alias("converted"),
        F.sum("p_revenue").cast("double").alias("session_revenue_usd"),
        F.min("p_device").alias("device_category"),
        F.min("p_geo").alias("geo_country"),
        F.bool_or("p_new_user").alias("is_new_user"),
    )
    for dst in TOUCH_COLUMNS:
        merged = merged.withColumn(dst, F.col(f"m_{dst}.v"))
    return merged.select(*SESSION_COLUMNS)


def first_touch_events(stg: DataFrame) -> DataFrame:
    """Which event supplied each first-touch column (they may differ)."""
    def src_event(c: str) -> Column:
        return F.min_by(F.col("event_id"), F.when(F.col(c).isNotNull(), _tie()))
    return stg.groupBy("session_key").agg(
        src_event("traffic_medium").alias("medium_event_id"),
        src_event("traffic_source").alias("source_event_id"),
        src_event("traffic_campaign").alias("campaign_event_id"),
        F.count(F.lit(1)).alias("n_events"),
    )


def paid_by_channel(sessions: DataFrame) -> DataFrame:
    """Any-touch treatment versus first-touch channel, session counts."""
    from liftlens.functions.channels import channel_of
    return (sessions.groupBy("is_paid", channel_of("first_touch_medium").alias("channel"))
            .agg(F.count(F.lit(1)).alias("sessions")))
