"""Items of events (G5): one row per item, revenue by item, items against the session's revenue.

``items`` is an array of structs beside the declared raw columns.  The flatten is an outer
``posexplode``: an event without items (null or empty array) stays as one row with no item.
Revenue of an item is its own figure, else price times quantity, else NULL (it adds nothing
and is counted as unpriced).  A NULL element of the array is an item without any field.

Scale: the flatten has no shuffle.  The reconciliation adds an event's items up inside its
row, so items never multiply the rows of the session rollup: one shuffle with partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.money import MONEY_SCALE, money, money_sum
from liftlens.operators.flatten import flatten_events
from liftlens.operators.sessions import SESSION_KEYS

ITEM_FIELDS = ("item_id", "item_name", "price_in_usd", "quantity")


def item_revenue(item: Column) -> Column:
    """Revenue of one item struct, NULL where nothing tells it."""
    return F.coalesce(item["item_revenue_in_usd"], item["price_in_usd"] * item["quantity"])


def flatten_items(raw: DataFrame, strict: bool = True) -> DataFrame:
    """One row per (event, item) of the events with a session, ``item_pos`` from 0; no item: one row of NULLs."""
    stg = flatten_events(raw, strict, keep=("items",))
    rows = stg.select("event_id", "event_date", "event_name", *SESSION_KEYS,
                      F.posexplode_outer("items").alias("item_pos", "_item"))
    item = F.col("_item")
    return rows.select("event_id", "event_date", "event_name", *SESSION_KEYS, "item_pos",
                       *[item[f].alias(f) for f in ITEM_FIELDS], item_revenue(item).alias("item_revenue_usd"))


def revenue_by_item(items: DataFrame) -> DataFrame:
    """Events, quantity and revenue per item; events without items do not count."""
    held = items.where(F.col("item_pos").isNotNull())
    # an event that lists an item twice counts once: first per (item, event), partial sums before the shuffle
    per_event = held.groupBy("item_id", "event_id").agg(
        F.sum("quantity").alias("q"), money_sum("item_revenue_usd").alias("r"),
        F.count_if(F.col("item_revenue_usd").isNull()).alias("u"))
    return per_event.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.coalesce(F.sum("q"), F.lit(0)).alias("quantity"),
        F.sum("r").cast("double").alias("revenue_usd"), F.sum("u").alias("n_unpriced"))


def reconcile_items(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Per session: revenue as the sessions have it (A6), revenue of its items, and the difference."""
    zero = F.lit(0).cast(f"decimal(38,{MONEY_SCALE})")
    stg = flatten_events(raw, strict, keep=("items",))
    of_items = F.aggregate(F.coalesce("items", F.array()), zero,
                           lambda total, i: money(total + F.coalesce(money(item_revenue(i)), zero)))
    per = stg.withColumns({"_n": F.coalesce(F.size("items"), F.lit(0)), "_items": of_items})
    sums = per.groupBy(*SESSION_KEYS).agg(
        F.count_if(F.col("event_name") == "purchase").alias("n_purchases"),
        F.count_if(F.col("_n") > 0).alias("n_events_with_items"),
        F.sum("_n").cast("bigint").alias("n_items"),
        money_sum("purchase_revenue_usd").alias("_a6"), money_sum("_items").alias("_of_items"))
    return sums.select(*SESSION_KEYS, "n_purchases", "n_events_with_items", "n_items",
                       F.col("_a6").cast("double").alias("session_revenue_usd"),
                       F.col("_of_items").cast("double").alias("item_revenue_usd"),
                       (F.col("_a6") - F.col("_of_items")).cast("double").alias("difference_usd"))
