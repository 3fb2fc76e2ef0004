"""Declared data tests (Q1-Q5) as DataFrames: one row per test with its
failure count, so the report itself is distributed and only the final
21-row result is ever looked at by the gate.

Failure counts follow the SQL the column tests run: ``not_null`` counts NULL
rows; ``unique`` counts distinct non-NULL values that occur more than once;
``accepted_values`` counts distinct non-NULL values outside the list (NULL
passes); ``relationships`` counts distinct child keys missing from the parent.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from liftlens.functions.channels import CHANNELS

# Accepted device categories.
DEVICE_CATEGORIES = ("desktop", "mobile", "tablet")


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    test: str                       # not_null | unique | accepted_values
    values: tuple[str, ...] = ()


# The declared column tests.
DECLARED_TESTS: tuple[ColumnTest, ...] = (
    ColumnTest("stg_ga4__events", "event_date_key", "not_null"),
    ColumnTest("stg_ga4__events", "event_date", "not_null"),
    ColumnTest("stg_ga4__events", "event_name", "not_null"),
    ColumnTest("stg_ga4__events", "user_pseudo_id", "not_null"),
    ColumnTest("stg_ga4__events", "session_key", "not_null"),
    ColumnTest("fct_sessions", "session_key", "not_null"),
    ColumnTest("fct_sessions", "session_key", "unique"),
    ColumnTest("fct_sessions", "session_date_key", "not_null"),
    ColumnTest("fct_sessions", "is_paid", "not_null"),
    ColumnTest("fct_sessions", "converted", "not_null"),
    ColumnTest("fct_sessions", "device_category", "accepted_values", DEVICE_CATEGORIES),
    ColumnTest("fct_causal_estimates", "method", "not_null"),
    ColumnTest("fct_causal_estimates", "method", "unique"),
    ColumnTest("fct_causal_estimates", "ate", "not_null"),
    ColumnTest("rpt_channel_performance", "channel", "not_null"),
    ColumnTest("rpt_channel_performance", "channel", "accepted_values", CHANNELS),
    ColumnTest("rpt_causal_summary", "estimate", "not_null"),
    ColumnTest("rpt_causal_summary", "estimate", "unique"),
    ColumnTest("rpt_causal_summary", "conversion_lift", "not_null"),
    ColumnTest("metricflow_time_spine", "date_day", "not_null"),
    ColumnTest("metricflow_time_spine", "date_day", "unique"),
)


def _row(t: ColumnTest, failures) -> list:
    return [F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
            F.lit(t.test).alias("test"), failures.cast("bigint").alias("failures")]


def not_null_columns(model: str, tests=DECLARED_TESTS) -> list[str]:
    """Columns of a model that have a ``not_null`` test."""
    return [t.column for t in tests if t.model == model and t.test == "not_null"]


def run_tests(models: dict[str, DataFrame], tests=DECLARED_TESTS, statistics: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate column tests; one scan per model for the row-wise tests plus
    one aggregation per ``unique`` column.

    ``statistics`` holds, for models that are written tables, their ``table_statistics`` with the
    NULLs of ``not_null_columns``: their ``not_null`` tests are answered from the footers."""
    parts = []
    for name, df in models.items():
        mine = [t for t in tests if t.model == name]
        if statistics and name in statistics:
            counted = [t for t in mine if t.test == "not_null"]
            mine = [t for t in mine if t.test != "not_null"]
            if counted:
                rows = F.explode(F.array(*[F.struct(*_row(t, F.col(f"nulls_{t.column}"))) for t in counted]))
                parts.append(statistics[name].select(rows.alias("r")).select("r.*"))
        rowwise = [t for t in mine if t.test in ("not_null", "accepted_values")]
        if rowwise:
            aggs = []
            for i, t in enumerate(rowwise):
                c = F.col(t.column)
                if t.test == "not_null":
                    aggs.append(F.count_if(c.isNull()).alias(f"f{i}"))
                else:
                    aggs.append(F.count_distinct(F.when(~c.isin(*t.values), c)).alias(f"f{i}"))
            one = df.agg(*aggs)
            stacked = F.explode(F.array(*[F.struct(*_row(t, F.col(f"f{i}"))) for i, t in enumerate(rowwise)]))
            parts.append(one.select(stacked.alias("r")).select("r.*"))
        for t in mine:
            if t.test == "unique":
                c = F.col(t.column)
                dup = (df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
                       .where(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("_f")))
                parts.append(dup.select(*_row(t, F.col("_f"))))
    missing = {t.model for t in tests} - set(models)
    if missing:
        raise KeyError(f"no DataFrame for models {sorted(missing)}")
    if not parts:
        some = next(iter(models.values()))
        return some.sparkSession.createDataFrame([], "model string, column_name string, test string, failures bigint")
    return reduce(DataFrame.unionByName, parts)


# --- tests that ride on a write ---------------------------------------------

def _violations(t: ColumnTest):
    """Rows that fail a row-wise test."""
    c = F.col(t.column)
    return F.count_if(c.isNull() if t.test == "not_null" else ~c.isin(*t.values))


def watch(df: DataFrame, model: str, tests=DECLARED_TESTS) -> tuple[DataFrame, Observation]:
    """``df`` with its model's ``not_null`` and ``accepted_values`` tests as observed metrics of the next action on it."""
    mine = _rowwise(model, tests)
    seen = Observation(f"tests of {model}")
    return df.observe(seen, *[_violations(t).alias(_metric(t)) for t in mine] or [F.count(F.lit(1)).alias("n")]), seen


def _rowwise(model: str, tests) -> list[ColumnTest]:
    return [t for t in tests if t.model == model and t.test in ("not_null", "accepted_values")]


def _metric(t: ColumnTest) -> str:
    return f"{t.column} {t.test}"


def run_watched_tests(models: dict[str, DataFrame], seen: dict[str, Observation], tests=DECLARED_TESTS) -> DataFrame:
    """``run_tests`` over written models, without a pass for tests that no row failed while the model was written.

    A stage that is run again after a lost executor may be counted twice, so an observed number
    is not exact; that it is zero is.  Tests with a violation are therefore counted on the
    written table as always, all others are zero without reading it.
    """
    passed = [t for model, o in seen.items() for t in _rowwise(model, tests) if o.get[_metric(t)] == 0]
    report = run_tests(models, tuple(t for t in tests if t not in passed))
    if not passed:
        return report
    # at most one row per declared test
    zeros = report.sparkSession.createDataFrame([(t.model, t.column, t.test, 0) for t in passed], report.schema)
    return report.unionByName(zeros)


def relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                  child_name: str, parent_name: str) -> DataFrame:
    """Q4: distinct non-NULL child keys without a parent row (left anti join)."""
    keys = child.select(F.col(child_col).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    # distinct parent keys: partial aggregation shrinks e.g. events to sessions
    # per map task before the join shuffle
    parents = parent.select(F.col(parent_col).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    orphans = keys.join(parents, "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(child_name).alias("child"), F.lit(child_col).alias("child_column"),
        F.lit(parent_name).alias("parent"), F.lit(parent_col).alias("parent_column"), "failures")


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Q5: raise before the causal step if any test failed; returns the report."""
    failed = report.where(F.col("failures") > 0).collect()   # at most one row per test
    if failed:
        lines = [f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed]
        raise QualityGateError("data tests failed: " + "; ".join(lines))
    return report
