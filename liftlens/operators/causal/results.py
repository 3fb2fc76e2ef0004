"""Estimate rows (C13) for one run; ``history`` has those of every daily run.

One run = every requested method on the same cells, with shared run
statistics (A15).  Estimates are stored as computed; rounding is for reports.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.operators.causal.cells import build_cells, run_stats
from liftlens.operators.causal.encode import CONFOUNDERS
from liftlens.operators.causal.estimators import (DEFAULT_CLIP, clipped, ipw_ate, matching_ate,
                                                  stratified_ate)
from liftlens.operators.causal.propensity import score_cells
from liftlens.operators.reports import MATCHING, STRATIFICATION, WEIGHTING
from liftlens.session import materialize

REFERENCE_METHODS = (MATCHING, WEIGHTING)
ALL_METHODS = (MATCHING, WEIGHTING, STRATIFICATION)
ESTIMATE_COLUMNS = ("method", "ate", "run_at", "naive_difference", "n_sessions", "n_paid",
                    "n_converted", "data_start", "data_end")


def method_estimates(scored: DataFrame, keys: Sequence[str], methods: Sequence[str] = REFERENCE_METHODS,
                     clip=DEFAULT_CLIP, num_strata="auto") -> DataFrame:
    """(keys, method, ate) for each requested method, stacked."""
    parts = []
    for m in methods:
        if m == MATCHING:
            est = matching_ate(scored, keys)
        elif m == WEIGHTING:
            est = ipw_ate(scored, keys, clip=clip)
        elif m == STRATIFICATION:
            est = stratified_ate(scored, keys, num_strata=num_strata)
        else:
            raise ValueError(f"unknown method {m!r}")
        parts.append(est.select(*keys, F.lit(m).alias("method"), "ate"))
    return reduce(DataFrame.unionByName, parts)


def assemble(est: DataFrame, stats: DataFrame, keys: Sequence[str], run_at) -> DataFrame:
    rows = est.join(stats, list(keys))
    return rows.select(
        "method", "ate", run_at.alias("run_at"),
        "naive_difference",
        F.col("n_sessions").cast("bigint"), F.col("n_paid").cast("bigint"),
        F.col("n_converted").cast("bigint"), "data_start", "data_end")


def causal_estimates(frame: DataFrame, run_at, methods: Sequence[str] = REFERENCE_METHODS,
                     model: str = "logit", clip=DEFAULT_CLIP,
                     confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """Rows of the estimates table for one run (``run_at``: a timestamp literal/column)."""
    # one model for the run; scored cells feed every estimator and the statistics: write them once
    scored = score_cells(_cells_with_dates(frame, confounders, []), model=model, confounders=confounders)
    scored = materialize(scored.withColumn("_run", F.lit(0)))
    est = method_estimates(scored, ["_run"], methods, clip)
    run_at = run_at if isinstance(run_at, Column) else F.lit(run_at)
    return assemble(est, _stats_with_dates(scored, ["_run"]), ["_run"], run_at.cast("timestamp_ntz"))


def _cells_with_dates(frame: DataFrame, confounders: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return frame.groupBy(*keys, *confounders).agg(
        F.count(F.lit(1)).alias("n"), F.sum("treatment").cast("bigint").alias("n1"),
        F.sum("outcome").cast("bigint").alias("y"),
        F.sum(F.col("treatment") * F.col("outcome")).cast("bigint").alias("y1"),
        F.min("session_date").alias("d_min"), F.max("session_date").alias("d_max"))


def _stats_with_dates(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    dates = cells.groupBy(*keys).agg(F.min("d_min").alias("data_start"), F.max("d_max").alias("data_end"))
    return run_stats(cells, keys).join(dates, list(keys))


def window_sensitivity(frame: DataFrame, unit: str = "week", methods: Sequence[str] = ALL_METHODS,
                       model: str = "saturated", clip=DEFAULT_CLIP,
                       confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """C12 (data windows): every method on each calendar window separately.

    Windows are a key of the cell aggregation, so all windows come from one
    pass over the sessions.
    """
    keyed = frame.withColumn("window_start", F.trunc("session_date", unit))
    return sensitivity_from_window_cells(build_cells(keyed, confounders, keys=["window_start"]),
                                         methods, model, clip, confounders)


def sensitivity_from_window_cells(cells: DataFrame, methods: Sequence[str] = ALL_METHODS,
                                  model: str = "saturated", clip=DEFAULT_CLIP,
                                  confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """``window_sensitivity`` from cells keyed by ``window_start`` (e.g. ``encoded_cells``)."""
    scored = materialize(score_cells(cells, model=model, confounders=confounders, keys=["window_start"]))
    est = method_estimates(scored, ["window_start"], methods, clip)
    sizes = scored.groupBy("window_start").agg(F.sum("n").alias("n_sessions"), F.sum("n1").alias("n_paid"))
    return est.join(sizes, "window_start").select(
        "window_start", "method", "ate", "n_sessions", "n_paid")


def window_clip_sensitivity(cells: DataFrame, clips: Sequence[tuple[float, float]], methods: Sequence[str] = ALL_METHODS,
                            model: str = "saturated", confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """C12, windows and clips together: every method on each window with each clip of the score.

    ``cells`` are keyed by ``window_start``; the grid is a key of the small cell table, not a join.
    """
    grid = F.explode(F.array(*[F.struct(F.lit(float(lo)).alias("clip_lo"), F.lit(float(hi)).alias("clip_hi"))
                               for lo, hi in clips]))
    scored = score_cells(cells, model=model, confounders=confounders, keys=["window_start"])
    keys = ["window_start", "clip_lo", "clip_hi"]
    crossed = scored.withColumn("_clip", grid).select("*", "_clip.clip_lo", "_clip.clip_hi").drop("_clip")
    crossed = materialize(crossed.withColumn("ps", clipped(F.col("ps"), F.col("clip_lo"), F.col("clip_hi"))), "clips")
    return method_estimates(crossed, keys, methods, clip=(0.0, 1.0)).select(*keys, "method", "ate")
