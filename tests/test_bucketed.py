"""Tables bucketed by the session key: no exchange on the key, same rows."""

import pytest

from conftest import SF_SMALL
from liftlens.operators.quality import DECLARED_TESTS, relationships, run_tests
from liftlens.operators.sessions import sessionize
from liftlens.plans import models as M
from liftlens.sources.bucketed import write_bucketed


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("gather", [True, False])
def test_rollup_unique_and_relationship_need_no_exchange(spark, gather):
    plain = M.staging(spark, SF_SMALL)
    stg = write_bucketed(plain, "staging", 5, gather=gather)
    sessions = sessionize(stg)
    assert "Exchange" not in _plan(sessions)
    expected = sessionize(plain)
    assert _rows(sessions) == _rows(expected)
    mart = write_bucketed(sessions, "sessions", 5, gather=gather)
    unique = [t for t in DECLARED_TESTS if t.model == "fct_sessions" and t.test == "unique"]
    report = run_tests({"fct_sessions": mart}, unique)
    assert "hashpartitioning" not in _plan(report)
    assert _rows(report) == _rows(run_tests({"fct_sessions": expected}, unique))
    for a, b in ((mart, stg), (stg, mart.where("is_paid"))):
        found = relationships(a, "session_key", b, "session_key", "child", "parent")
        assert "hashpartitioning" not in _plan(found)
    lost = relationships(stg, "session_key", mart.where("is_paid"), "session_key", "child", "parent")
    assert lost.first().failures == expected.where("is_paid is null or not is_paid").select("session_key").distinct().count()


def test_odd_keys(spark):
    rows = [(None, 1), (None, 2), ("", 3), ("a", 4), ("a", 4)]
    df = spark.createDataFrame(rows, "session_key string, n int")
    for some in (df, df.limit(0)):
        assert _rows(write_bucketed(some, "odd", 3)) == _rows(some)
