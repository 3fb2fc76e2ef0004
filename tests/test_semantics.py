"""Semantic traps of flattening and sessionization on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from liftlens.operators.flatten import flatten_events
from liftlens.operators.sessions import merge_partials, session_partials, sessionize
from liftlens.schema import RAW_EVENT, SchemaDriftError, check_schema
from liftlens.sources.shards import split_partition_range

DAY_US = 86_400_000_000
T0 = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC


def _p(key, iv=None, sv=None):
    return {"key": key, "value": {"string_value": sv, "int_value": iv, "float_value": None, "double_value": None}}


def _ev(eid, ts, name="page_view", user="u1", params=None, medium=None, source=None, campaign=None,
        device="desktop", country="C1", revenue=None, date=None):
    date = date or (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=ts)).strftime("%Y%m%d")
    return (eid, date, ts, name, user, params if params is not None else [_p("ga_session_id", 7)],
            {"medium": medium, "source": source, "name": campaign}, {"category": device},
            {"country": country}, {"purchase_revenue_in_usd": revenue})


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_EVENT)


def test_param_lookup_missing_null_and_first_wins(spark):
    rows = [_ev(1, T0, params=[]),
            _ev(2, T0 + 1, params=[_p("other", 1), _p("ga_session_id", None)]),
            _ev(3, T0 + 2, params=[_p("ga_session_id", 5), _p("ga_session_id", 6)])]
    stg = flatten_events(raw(spark, rows), strict=False)
    got = {r.event_id: r.ga_session_id for r in stg.collect()}
    assert got == {3: 5}   # no key and NULL value are dropped; first duplicate wins


def test_param_lookup_strict_raises_on_duplicate(spark):
    rows = [_ev(3, T0, params=[_p("ga_session_id", 5), _p("ga_session_id", 6)])]
    with pytest.raises(Exception, match="more than one"):
        flatten_events(raw(spark, rows)).collect()


def test_param_lookup_of_null_entries_keys_and_arrays(spark):
    from liftlens.functions.params import param_value
    lists = [None, [], [None, _p(None, 1), _p("k", 2, "x")], [{"key": "k", "value": None}], [_p("k"), _p("j", 1), _p("j", 2)]]
    df = spark.createDataFrame(list(enumerate(lists)), "n int, p " + RAW_EVENT["event_params"].dataType.simpleString())
    got = df.select("n", param_value("p", "k").alias("i"), param_value("p", "k", "string_value").alias("s")).orderBy("n")
    assert [tuple(r) for r in got.collect()] == [(0, None, None), (1, None, None), (2, 2, "x"), (3, None, None), (4, None, None)]
    assert dict(got.dtypes) == {"n": "int", "i": "bigint", "s": "string"}


def test_null_user_gives_null_session_key(spark):
    stg = flatten_events(raw(spark, [_ev(1, T0, user=None)]))
    assert stg.first().session_key is None


def test_malformed_event_date_raises(spark):
    with pytest.raises(Exception):
        flatten_events(raw(spark, [_ev(1, T0, date="2024-13-45")])).collect()


def test_first_touch_independent_columns_and_tie_key(spark):
    rows = [_ev(10, T0 + 5, medium=None, source="google"),
            _ev(11, T0 + 5, medium="cpc", source="bing"),       # same time, higher id
            _ev(9, T0 + 5, medium="organic", campaign=None),    # same time, lowest id
            _ev(12, T0 + 9, campaign="c1", name="purchase", revenue=1.005),
            _ev(13, T0 + 10, name="purchase", revenue=2.0)]
    s = sessionize(flatten_events(raw(spark, rows))).first()
    assert s.first_touch_medium == "organic"       # event 9 wins the tie
    assert s.first_touch_source == "google"        # event 10: earliest non-null source
    assert s.first_touch_campaign == "c1"
    assert s.is_paid is True and s.converted is True
    assert s.session_revenue_usd == pytest.approx(3.005)  # summed as it is, rounded in the report only


def test_all_null_medium_gives_null_treatment(spark):
    rows = [_ev(1, T0), _ev(2, T0 + 1)]
    assert sessionize(flatten_events(raw(spark, rows))).first().is_paid is None
    rows = [_ev(1, T0), _ev(2, T0 + 1, medium="organic")]
    assert sessionize(flatten_events(raw(spark, rows))).first().is_paid is False


def test_midnight_session_attributed_to_first_day(spark):
    rows = [_ev(1, T0 + DAY_US - 10, medium="organic"), _ev(2, T0 + DAY_US + 10, name="purchase", revenue=3.0)]
    s = sessionize(flatten_events(raw(spark, rows))).collect()
    assert len(s) == 1 and s[0].session_date == dt.date(2024, 1, 1) and s[0].converted


def test_partials_merge_equals_full_rollup(spark):
    rows = [_ev(1, T0 + DAY_US - 10, medium=None, source="a"), _ev(2, T0 + DAY_US + 10, medium="cpc"),
            _ev(3, T0 + 2 * DAY_US + 1, medium="organic", name="purchase", revenue=1.1)]
    stg = flatten_events(raw(spark, rows))
    assert sorted(merge_partials(session_partials(stg)).collect()) == sorted(sessionize(stg).collect())


def test_schema_guard(spark):
    df = raw(spark, [_ev(1, T0)])
    check_schema(df, RAW_EVENT)
    with pytest.raises(SchemaDriftError):
        check_schema(df.withColumn("extra", F.lit(1)), RAW_EVENT)


def test_partition_range_rejects(spark):
    rows = [_ev(1, T0), _ev(2, T0 + 40 * DAY_US)]
    inside, rejects = split_partition_range(flatten_events(raw(spark, rows)), 20240101, 20240201)
    assert [r.event_id for r in inside.collect()] == [1]
    assert [r.event_id for r in rejects.collect()] == [2]


def test_summary_of_empty_estimates_has_one_naive_row(spark):
    from liftlens.operators.reports import causal_summary, latest_estimates
    from liftlens.schema import ESTIMATES
    empty = spark.createDataFrame([], ESTIMATES)
    rows = causal_summary(latest_estimates(empty)).collect()
    assert len(rows) == 1 and rows[0].estimate == "naive_correlation" and rows[0].conversion_lift is None


def test_one_hot_names_and_collisions(spark):
    from liftlens.operators.causal.encode import confounder_levels, confounder_names, one_hot

    def frame(*geos):
        return spark.createDataFrame([(f"s{i}", 1, 0, 0, "desktop", g) for i, g in enumerate(geos)],
                                     "session_key string, treatment int, outcome int, is_new_user int, device string, geo string")
    with pytest.raises(ValueError, match="collide"):
        confounder_names(confounder_levels(frame("<Other>", "Other")))
    wide = one_hot(frame("New Zealand", "C1"))
    assert wide.columns[-3:] == ["device_desktop", "geo_C1", "geo_New_Zealand"]
    assert {r.session_key: r.geo_New_Zealand for r in wide.collect()} == {"s0": 1, "s1": 0}
    with pytest.raises(ValueError, match="more than 1 levels"):
        confounder_levels(frame("a", "b"), max_levels=1)


def test_top_levels_ties_broken_by_name(spark):
    from liftlens.operators.causal.encode import top_levels
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "g string")
    assert [r.g for r in top_levels(df, "g", 2).collect()] == ["c", "a"]
