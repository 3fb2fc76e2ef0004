"""Items of events: none is lost, odd arrays, revenue against the sessions' own."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from liftlens.operators.flatten import flatten_events
from liftlens.operators.items import flatten_items, reconcile_items, revenue_by_item
from liftlens.operators.sessions import sessionize
from liftlens.plans import models as M

ITEM = "struct<item_id: string, item_name: string, price_in_usd: double, quantity: bigint, item_revenue_in_usd: double>"


def _with(spark, lists):
    """The first events with a session, one list of items each."""
    raw = M.raw_events(spark, SF_SMALL).where(F.col("event_id") % 37 != 0).orderBy("event_id").limit(len(lists))
    ids = [r.event_id for r in raw.select("event_id").collect()]
    items = spark.createDataFrame(list(zip(ids, lists)), f"event_id long, items array<{ITEM}>")
    return raw.join(items, "event_id").select(*raw.columns, "items"), ids


def test_odd_arrays(spark):
    lists = [None, [], [("a", "x", 2.0, 3, None), ("a", "x", 2.0, 1, 5.0)], [None], [("b", None, None, 4, None)],
             [(None, None, 1.0, None, 0.0000001)], [("a", None, -1.5, 2, None)]]
    raw, ids = _with(spark, lists)
    found = {}
    for r in flatten_items(raw).orderBy("event_id", "item_pos").collect():
        found.setdefault(r.event_id, []).append((r.item_pos, r.item_id, r.quantity, r.item_revenue_usd))
    none = (None, None, None, None)
    assert [found[i] for i in ids] == [
        [none], [none], [(0, "a", 3, 6.0), (1, "a", 1, 5.0)], [(0, None, None, None)], [(0, "b", 4, None)],
        [(0, None, None, 0.0000001)], [(0, "a", 2, -3.0)]]
    per = {r.item_id: tuple(r)[1:] for r in revenue_by_item(flatten_items(raw)).collect()}
    assert per == {"a": (2, 6, 8.0, 0), "b": (1, 4, 0.0, 1), None: (2, 0, 0.0000001, 1)}
    sums = reconcile_items(raw).agg(F.sum("n_events_with_items"), F.sum("n_items"), F.sum("item_revenue_usd")).first()
    assert (sums[0], sums[1], round(sums[2], 9)) == (5, 6, 8.0000001)
    assert flatten_items(raw.limit(0)).collect() == [] and revenue_by_item(flatten_items(raw.limit(0))).collect() == []


def test_every_event_stays_and_revenue_is_that_of_the_sessions(spark):
    raw = M.raw_items(spark, SF_SMALL)
    stg = flatten_events(raw)
    assert flatten_items(raw).select("event_id").distinct().count() == stg.count()
    found = {r.session_key: r for r in reconcile_items(raw).collect()}
    sessions = {r.session_key: r.session_revenue_usd for r in sessionize(stg).collect()}
    assert {k: r.session_revenue_usd for k, r in found.items()} == sessions
    items = {r.session_key: r.n for r in flatten_items(raw).groupBy("session_key").agg(F.count("item_pos").alias("n")).collect()}
    assert {k: r.n_items for k, r in found.items()} == items and sum(items.values()) > 100
    # items that add up to what the event says leave no difference
    says = raw.withColumn("items", F.when(F.col("ecommerce.purchase_revenue_in_usd").isNotNull(), F.array(F.struct(
        F.lit("i").alias("item_id"), F.lit(None).cast("string").alias("item_name"), F.lit(None).cast("double").alias("price_in_usd"),
        F.lit(1).cast("bigint").alias("quantity"), F.col("ecommerce.purchase_revenue_in_usd").alias("item_revenue_in_usd")))))
    assert reconcile_items(says).where("difference_usd <> 0").count() == 0


def test_reconciliation_is_one_shuffle_without_explode(spark, workdir):
    M.raw_items(spark, SF_SMALL).write.parquet(f"{workdir}/raw")
    p = reconcile_items(spark.read.parquet(f"{workdir}/raw"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", p)) == 1 and "Generate" not in p
