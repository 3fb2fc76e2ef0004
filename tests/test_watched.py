"""Data tests that ride on the write of a model."""

from liftlens.operators.quality import DECLARED_TESTS, run_tests, run_watched_tests, watch
from liftlens.session import materialize

SCHEMA = "session_key string, session_date_key long, is_paid boolean, converted boolean, device_category string"
TESTS = tuple(t for t in DECLARED_TESTS if t.model == "fct_sessions")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _written(spark, rows):
    df, seen = watch(spark.createDataFrame(rows, SCHEMA).repartition(3), "fct_sessions", TESTS)
    return {"fct_sessions": materialize(df)}, {"fct_sessions": seen}


def test_watched_report_equals_the_plain_one(spark):
    clean = [(f"k{i}", i, True, i % 2 == 0, "mobile") for i in range(9)]
    broken = [*clean, ("k1", None, None, True, "tv"), (None, 3, None, False, None), ("k1", 4, True, None, "tv"), ("z", 5, True, True, "x")]
    for rows in (clean, broken, []):
        models, seen = _written(spark, rows)
        assert _rows(run_watched_tests(models, seen, TESTS)) == _rows(run_tests(models, TESTS))
    failures = {(r.column_name, r.test): r.failures for r in run_watched_tests(models, seen, TESTS).collect()}
    assert len(failures) == len(TESTS) and set(failures.values()) == {0}


def test_a_clean_model_is_read_for_its_unique_tests_only(spark):
    models, seen = _written(spark, [("k", 1, True, True, "tablet")])
    p = run_watched_tests(models, seen, TESTS)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in p.splitlines() if "Scan parquet" in line or "FileScan" in line]
    assert len(scans) == 1 and "ReadSchema: struct<session_key:string>" in scans[0]
    rowwise = tuple(t for t in TESTS if t.test != "unique")
    assert _rows(run_watched_tests(models, seen, rowwise)) == _rows(run_tests(models, rowwise))


def test_an_exact_count_is_taken_where_the_write_saw_a_violation(spark):
    """A write that ran a stage twice would count twice: the report counts the written rows."""
    df, seen = watch(spark.createDataFrame([("k", 1, None, True, "tablet")], SCHEMA), "fct_sessions", TESTS)
    models = {"fct_sessions": materialize(df)}
    twice = type("Twice", (), {"get": {k: 2 * v for k, v in seen.get.items()}})()
    report = {r.column_name: r.failures for r in run_watched_tests(models, {"fct_sessions": twice}, TESTS).collect()
              if r.test == "not_null"}
    assert report["is_paid"] == 1 and report["converted"] == 0
