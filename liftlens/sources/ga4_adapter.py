"""GA4-shaped nested raw events derived from the testdata ``events`` table.

The reference consumes daily GA4 export shards (nested ``event_params``,
``traffic_source``, ``device``, ``geo``, ``ecommerce`` structs).  The driver's
testdata has a flat ``events`` table instead, so this adapter derives the
nested shape from it with plain column expressions (one narrow projection, no
shuffle).  The derivation rules are the fixed ones of FIXTURES.md section 1,
plus one extra ``engagement_k`` parameter so that the session-id lookup has
to find its key among several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.timeconv import micros_since_epoch

# Fixed values of the adapter (FIXTURES.md section 1).
MICROS_PER_DAY = 86_400_000_000
SESSION_DAY_OFFSET_US = 43_200_000_000  # sessions run noon to noon, so they cross midnight
NO_SESSION_EVERY = 37                   # event_id % 37 = 0 carries no ga_session_id
EVENT_NAME_MAP = {"signup": "first_visit", "view": "page_view", "error": "session_start"}
SOURCE_BY_K_MOD_4 = ["google", "newsletter", "(direct)", None]


def _param(key: str, int_value: Column) -> Column:
    value = F.struct(
        F.lit(None).cast("string").alias("string_value"),
        int_value.cast("bigint").alias("int_value"),
        F.lit(None).cast("double").alias("float_value"),
        F.lit(None).cast("double").alias("double_value"),
    )
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def _medium(k: Column, user_id: Column) -> Column:
    m = (user_id % 3) * 3
    return (F.when(k < m + 2, "cpc")
            .when(k < m + 3, "cpm")
            .when(k < 35, "organic")
            .when(k < 50, "referral")
            .when(k < 70, "(none)")
            .when(k < 80, "<Other>")
            .when(k < 90, "email"))


def _event_name(event_type: Column) -> Column:
    out = None
    for src, dst in EVENT_NAME_MAP.items():
        out = (F if out is None else out).when(event_type == src, dst)
    return out.otherwise(event_type)


def ga4_events(events: DataFrame) -> DataFrame:
    """Nested raw events (one row per event), columns as a GA4 export shard."""
    us = micros_since_epoch(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        "event_id", "user_id", "event_type", "value",
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        us.alias("event_timestamp"),
        k.alias("_k"),
    )
    k, uid = F.col("_k"), F.col("user_id")
    sid = F.expr(f"(event_timestamp - {SESSION_DAY_OFFSET_US}) div {MICROS_PER_DAY}")
    params = (F.when(F.col("event_id") % NO_SESSION_EVERY == 0,
                     F.array(_param("engagement_k", k)))
              .otherwise(F.array(_param("engagement_k", k), _param("ga_session_id", sid))))
    source = (F.when(k % 4 == 0, SOURCE_BY_K_MOD_4[0])
              .when(k % 4 == 1, SOURCE_BY_K_MOD_4[1])
              .when(k % 4 == 2, SOURCE_BY_K_MOD_4[2]))
    campaign = F.when(k % 6 < 5, F.concat(F.lit("camp"), (k % 6).cast("string")))
    device = F.when(uid % 10 < 5, "desktop").when(uid % 10 < 9, "mobile").otherwise("tablet")
    g = F.expr("(user_id div 7) % 16")
    country = F.when(g != 15, F.concat(F.lit("C"), g.cast("string")))
    return base.select(
        "event_id",
        "event_date",
        "event_timestamp",
        _event_name(F.col("event_type")).alias("event_name"),
        F.concat(F.lit("u"), uid.cast("string")).alias("user_pseudo_id"),
        params.alias("event_params"),
        F.struct(_medium(k, uid).alias("medium"), source.alias("source"),
                 campaign.alias("name")).alias("traffic_source"),
        F.struct(device.alias("category")).alias("device"),
        F.struct(country.alias("country")).alias("geo"),
        F.struct(F.when(F.col("event_type") == "purchase", F.col("value"))
                 .alias("purchase_revenue_in_usd")).alias("ecommerce"),
    )


def with_items(raw: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``raw`` with an ``items`` array: a purchase lists the lines of the order of its number, other events none."""
    line = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.lit(None).cast("string").alias("item_name"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_in_usd"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("item_revenue_in_usd"))
    lists = lineitem.groupBy(F.col("l_orderkey").alias("_order")).agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    joined = raw.join(lists, (F.col("event_id") == F.col("_order")) & (F.col("event_name") == "purchase"), "left")
    items = F.transform("_lines", lambda x: F.struct(
        *[x[f].alias(f) for f in ("item_id", "item_name", "price_in_usd", "quantity", "item_revenue_in_usd")]))
    return joined.select(*raw.columns, items.alias("items"))
