"""Governed metrics (M1-M9): a small registry of semantic models, measures
and metrics that turns a metric request into one ``groupBy().agg()`` per
semantic model.

A metric's filter applies to its own measure only (conditional aggregation),
ratio metrics divide *after* grouping (ratio of sums, never a mean of
ratios), and metrics of different models are combined with a full outer join
on the shared group-by columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.money import money

METRIC_TIME = "metric_time__day"
GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str                       # count | sum | average | sum_money
    expr: str                      # SQL expression over the model's columns
    columns: tuple[str, ...]       # columns the expression needs (M9)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    entity: str
    time_dimension: str
    dimensions: tuple[str, ...]
    measures: dict[str, Measure] = field(default_factory=dict)


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                                    # simple | ratio
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    filter: Callable[[], Column] | None = None   # applies to this metric's measures only


# The declared semantic models.
SESSIONS_MODEL = SemanticModel(
    name="sessions", entity="session", time_dimension="session_date",
    dimensions=("session_date", "device_category", "geo_country", "is_paid", "is_new_user",
                "first_touch_medium"),
    measures={
        "sessions": Measure("sessions", "count", "session_key", ("session_key",)),
        "conversions": Measure("conversions", "sum", "CAST(converted AS BIGINT)", ("converted",)),
        "revenue_usd": Measure("revenue_usd", "sum_money", "session_revenue_usd", ("session_revenue_usd",)),
    })

ESTIMATES_MODEL = SemanticModel(
    name="causal_estimates", entity="causal_estimate", time_dimension="run_date",
    dimensions=("run_date", "method"),
    measures={
        "avg_ate": Measure("avg_ate", "average", "ate", ("ate",)),
        "avg_naive_difference": Measure("avg_naive_difference", "average", "naive_difference",
                                        ("naive_difference",)),
    })

SEMANTIC_MODELS = {m.name: m for m in (SESSIONS_MODEL, ESTIMATES_MODEL)}


def _weighting_only() -> Column:
    return F.col("method") == F.lit("propensity_score_weighting")


# The declared metrics.
METRICS: dict[str, Metric] = {m.name: m for m in (
    Metric("sessions", "simple", measure="sessions"),
    Metric("conversions", "simple", measure="conversions"),
    Metric("conversion_rate", "ratio", numerator="conversions", denominator="sessions"),
    Metric("revenue", "simple", measure="revenue_usd"),
    Metric("causal_lift_estimate", "simple", measure="avg_ate", filter=_weighting_only),
    Metric("naive_conversion_lift", "simple", measure="avg_naive_difference", filter=_weighting_only),
)}


def _model_of(measure: str) -> SemanticModel:
    for m in SEMANTIC_MODELS.values():
        if measure in m.measures:
            return m
    raise KeyError(f"no semantic model defines measure {measure!r}")


def time_grain(name: str) -> str | None:
    """Grain of a ``metric_time__<grain>`` name, None for other names."""
    prefix, _, grain = name.partition("__")
    if prefix != "metric_time":
        return None
    if grain not in GRAINS:
        raise KeyError(f"{name!r}: the time grain is one of {GRAINS}")
    return grain


def at_grain(day: Column, grain: str) -> Column:
    """First day of the week (Monday), month, quarter or year that holds ``day``."""
    return day if grain == "day" else F.trunc(day, grain)


def _dimension_column(model: SemanticModel, name: str) -> Column:
    if (grain := time_grain(name)) is not None:
        return at_grain(F.to_date(F.col(model.time_dimension)), grain).alias(name)
    dim = name.split("__", 1)[1] if "__" in name else name
    if "__" in name and name.split("__", 1)[0] != model.entity:
        raise KeyError(f"{name!r} is not a dimension of model {model.name!r}")
    if dim not in model.dimensions:
        raise KeyError(f"{dim!r} is not a dimension of model {model.name!r}")
    return F.col(dim).alias(name)


def _aggregate(measure: Measure, cond: Column | None) -> Column:
    e = F.expr(measure.expr)
    if cond is not None:
        e = F.when(cond, e)
    if measure.agg == "count":
        return F.count(e)
    if measure.agg == "sum":
        return F.sum(e)
    if measure.agg == "sum_money":
        return F.sum(money(e)).cast("double")
    if measure.agg == "average":
        return F.avg(e)
    raise ValueError(measure.agg)


def validate(tables: dict[str, DataFrame], metrics: Sequence[str] = tuple(METRICS)) -> None:
    """M9: every metric's measures and filter columns exist on its model's table."""
    for name in metrics:
        metric = METRICS[name]
        for ms in filter(None, (metric.measure, metric.numerator, metric.denominator)):
            model = _model_of(ms)
            if model.name not in tables:
                raise KeyError(f"metric {name!r} needs table for model {model.name!r}")
            cols = set(tables[model.name].columns)
            need = set(model.measures[ms].columns) | {model.time_dimension}
            if metric.filter is not None:
                need.add("method")
            if not need <= cols:
                raise KeyError(f"metric {name!r}: columns {sorted(need - cols)} missing on {model.name!r}")


def query_metrics(tables: dict[str, DataFrame], metrics: Sequence[str], group_by: Sequence[str] = (),
                  where: Column | None = None, spine: DataFrame | None = None,
                  fill_nulls_with: int | None = None) -> DataFrame:
    """Metrics grouped by dimensions, one aggregation per semantic model.

    ``metric_time__<grain>`` groups by day, week, month, quarter or year.  ``spine``
    (a ``date_day`` frame) left-joins the result on it so missing periods appear; ``fill_nulls_with`` then fills the metric NULLs.
    """
    validate(tables, metrics)
    per_model: dict[str, list[tuple[str, Column]]] = {}
    ratios = []
    for name in metrics:
        m = METRICS[name]
        cond = m.filter() if m.filter else None
        if m.kind == "simple":
            model = _model_of(m.measure)
            per_model.setdefault(model.name, []).append((name, _aggregate(model.measures[m.measure], cond)))
        else:
            model = _model_of(m.numerator)
            per_model.setdefault(model.name, []).extend([
                (f"_{name}_num", _aggregate(model.measures[m.numerator], cond)),
                (f"_{name}_den", _aggregate(model.measures[m.denominator], cond))])
            ratios.append(name)
    results = []
    for model_name, aggs in per_model.items():
        model = SEMANTIC_MODELS[model_name]
        df = tables[model_name]
        if where is not None:
            df = df.where(where)
        dims = [_dimension_column(model, g) for g in group_by]
        out = df.groupBy(*dims).agg(*[a.alias(n) for n, a in aggs]) if dims else df.agg(
            *[a.alias(n) for n, a in aggs])
        for r in ratios:
            if f"_{r}_num" in out.columns:
                out = out.withColumn(r, F.try_divide(F.col(f"_{r}_num").cast("double"),
                                                     F.col(f"_{r}_den"))).drop(f"_{r}_num", f"_{r}_den")
        results.append(out)
    keys = list(group_by)
    if len(results) > 1 and not keys:
        raise ValueError("metrics of several models need a shared group-by")
    res = reduce(lambda a, b: a.join(b, keys, "full_outer"), results)
    if spine is not None:
        times = [k for k in keys if time_grain(k) is not None]
        if len(times) != 1:
            raise ValueError("a time spine needs one metric_time__<grain> in group_by")
        periods = spine.select(at_grain(F.col("date_day"), time_grain(times[0])).alias(times[0])).distinct()
        res = periods.join(res, times[0], "left")
        if fill_nulls_with is not None:
            res = res.fillna(fill_nulls_with, subset=list(metrics))
    return res.select(*keys, *metrics)


def time_spine(start: Column, end: Column) -> Column:
    """M8: the day sequence [start, end] (inclusive) as an exploding column."""
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def spine_from(df: DataFrame, date_col: str) -> DataFrame:
    """Day spine over the date range that ``df`` actually covers."""
    bounds = df.agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    return bounds.select(time_spine(F.col("_a"), F.col("_b")).alias("date_day"))


def spine_from_statistics(statistics: DataFrame, date_col: str) -> DataFrame:
    """The same spine from a written table's statistics (``table_statistics``): no row is read."""
    return statistics.select(time_spine(F.col(f"min_{date_col}"), F.col(f"max_{date_col}")).alias("date_day"))


# The day window of the reference's time spine.
REFERENCE_SPINE = ("2020-11-01", "2021-01-31")


def date_spine(spark, start: str = REFERENCE_SPINE[0], end: str = REFERENCE_SPINE[1]) -> DataFrame:
    """M8: one row per day of a fixed window (inclusive), e.g. the reference's 92 days."""
    return spark.range(1).select(time_spine(F.to_date(F.lit(start)), F.to_date(F.lit(end))).alias("date_day"))
