"""Confounder cells (C2): the sufficient statistics of every estimator here.

With categorical confounders, every propensity model and every estimator
depends on the data only through, per confounder cell,
``n`` (units), ``n1`` (treated), ``y`` (outcomes) and ``y1`` (treated
outcomes).  One ``groupBy`` turns any number of sessions into at most
``prod(levels)`` rows – partial aggregation happens map-side, so the shuffle
carries (tasks x cells) rows whatever the data size, and a hot cell holding a
third of all rows costs no more than any other.

Extra ``keys`` (replicate, simulation, run date, ...) give one cell table per
key value in the same pass.  ``weight`` sums a weight column instead of
counting rows (bootstrap weights, pre-aggregated inputs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.operators.causal.encode import CONFOUNDERS

CELL_STATS = ("n", "n1", "y", "y1")


def build_cells(frame: DataFrame, confounders: Sequence[str] = CONFOUNDERS,
                treatment: str = "treatment", outcome: str = "outcome",
                keys: Sequence[str] = (), weight: str | Column | None = None) -> DataFrame:
    w = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    t, y = F.col(treatment), F.col(outcome)
    return (frame.groupBy(*keys, *confounders)
            .agg(F.sum(w).cast("bigint").alias("n"),
                 F.sum(w * t).cast("bigint").alias("n1"),
                 F.sum(w * y).cast("bigint").alias("y"),
                 F.sum(w * t * y).cast("bigint").alias("y1")))


def merge_cells(cells: DataFrame, confounders: Sequence[str] = CONFOUNDERS,
                keys: Sequence[str] = ()) -> DataFrame:
    """Re-aggregate cell tables (e.g. per-day cells into run-date cells)."""
    return cells.groupBy(*keys, *confounders).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in CELL_STATS])


def n0() -> Column:
    return F.col("n") - F.col("n1")


def y0() -> Column:
    return F.col("y") - F.col("y1")


def run_stats(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A15 + C3 per key: sizes and the naive difference P(y|t=1) - P(y|t=0).

    A missing arm gives NULL (the reference gives NaN).
    """
    agg = cells.groupBy(*keys).agg(
        F.sum("n").alias("n_sessions"), F.sum("n1").alias("n_paid"),
        F.sum("y").alias("n_converted"), F.sum("y1").alias("_y1"))
    rate1 = F.try_divide(F.col("_y1"), F.col("n_paid"))
    rate0 = F.try_divide(F.col("n_converted") - F.col("_y1"), F.col("n_sessions") - F.col("n_paid"))
    return agg.select(*keys, "n_sessions", "n_paid", "n_converted",
                      (rate1 - rate0).alias("naive_difference"))
