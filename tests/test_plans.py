"""Physical-plan properties that matter at scale (pushdown, pruning, shuffles, broadcasts)."""

import re

from conftest import SF_SMALL
from liftlens.plans import models as M
from liftlens.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_predicate_and_columns_reach_parquet(spark):
    p = plan(QUERIES["orders_urgency_ipw"](spark, SF_SMALL))
    scan = [l for l in p.splitlines() if "lineitem.parquet" in l][0]
    assert "EqualTo(l_returnflag,R)" in scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in scan


def test_adapter_prunes_unused_event_columns(spark):
    from liftlens.sources.shards import shard_row_counts
    p = plan(shard_row_counts(M.raw_events(spark, SF_SMALL).withColumn("shard", M.F.col("event_date"))))
    scan = [l for l in p.splitlines() if "events.parquet" in l][0]
    assert "ReadSchema: struct<ts:timestamp_ntz>" in scan


def test_filter_on_a_looked_up_parameter_derives_the_parameters_once(spark):
    p = plan(M.staging(spark, SF_SMALL))
    below = [l for l in p.splitlines() if " Filter " in l][0]
    # the adapter builds the array in one of two branches, each with one engagement value
    assert below.count("get_json_object") == 2


def test_session_rollup_is_one_shuffle_with_partial_aggregation(spark):
    p = plan(M.sessions(spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "partial_min_by" in p


def test_top_countries_side_is_broadcast(spark):
    p = plan(M.frame(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "TakeOrderedAndProject" in p
    assert "SortMergeJoin" not in p


def test_latest_per_method_uses_window_group_limit(spark):
    from liftlens.operators.reports import latest_estimates
    est = spark.createDataFrame(
        [("m", 1.0, 0.0, 1, 1, 1), ("m", 2.0, 0.0, 1, 1, 1)],
        "method string, ate double, naive_difference double, n_sessions long, n_paid long, n_converted long")
    from pyspark.sql import functions as F
    est = (est.withColumn("run_at", F.current_timestamp().cast("timestamp_ntz"))
              .withColumn("data_start", F.current_date()).withColumn("data_end", F.current_date()))
    assert "WindowGroupLimit" in plan(latest_estimates(est))


def test_one_shard_read_prunes_by_timestamp_range(spark):
    p = plan(QUERIES["flatten_one_shard"](spark, SF_SMALL))
    scan = [l for l in p.splitlines() if "events.parquet" in l][0]
    assert "GreaterThanOrEqual(ts," in scan and "LessThan(ts," in scan


def test_no_registered_query_plans_a_cross_join(spark):
    bad = {}
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in p]
        if hits:
            bad[name] = hits
    assert not bad, bad
