"""Placebo-treatment refuter (C8): permute the treatment, re-estimate, average.

Permutation ``s`` gives the placebo treatment to the N1 units with the
smallest hash (h, session_key) of (session_key, s, seed) – exactly as many
treated units as in the data, as a permutation does.

Ranking all units per simulation with a window partitioned by simulation
would put a whole simulation into one task.  Instead the hash range is cut
into ``buckets``: a counts table (sims x buckets rows, built with partial
aggregation) locates the bucket where the running count crosses N1; units in
lower buckets are treated, in higher buckets not, and only the boundary
bucket (about N/buckets units per simulation) is ranked.  Same result as the
plain ``row_number`` version, which serves as the SQL oracle.

``method='grouped'`` draws the same permutation distribution from the cell
table alone: under a random permutation the placebo-treated counts per cell
are multivariate hypergeometric (N1 labels over the cells' sizes), and the
placebo-treated outcomes of a cell are hypergeometric given that count.  One
``applyInPandas`` group per simulation holds one cell table (bounded by the
encoding), so the cost does not grow with the number of sessions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.functions.hashing import uniform
from liftlens.operators.causal.cells import build_cells
from liftlens.operators.causal.encode import CONFOUNDERS
from liftlens.operators.causal.estimators import DEFAULT_CLIP
from liftlens.operators.causal.propensity import score_cells
from liftlens.operators.causal.results import method_estimates
from liftlens.operators.reports import WEIGHTING

SIMULATIONS = 10
SEED = 42
BUCKETS = 1 << 16


def placebo_frame(frame: DataFrame, simulations: int = SIMULATIONS, seed: int = SEED,
                  buckets: int = BUCKETS, confounders: Sequence[str] = CONFOUNDERS,
                  key: str = "session_key") -> DataFrame:
    """Unit rows x simulations with the permuted treatment in column ``treatment``."""
    sims = F.explode(F.sequence(F.lit(0), F.lit(simulations - 1))).alias("sim")
    x = frame.select(key, "treatment", "outcome", *confounders, sims)
    x = x.withColumn("_h", uniform(F.col(key), F.lit("placebo"), F.col("sim"), F.lit(seed)))
    x = x.withColumn("_b", F.floor(F.col("_h") * buckets).cast("int"))
    counts = x.groupBy("sim", "_b").agg(F.count(F.lit(1)).alias("_c"), F.sum("treatment").alias("_t"))
    run = Window.partitionBy("sim").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (counts.withColumn("_cum", F.sum("_c").over(run))
              .withColumn("_n1", F.sum("_t").over(Window.partitionBy("sim"))))
    boundary = (counts.where(F.col("_cum") >= F.col("_n1"))
                .groupBy("sim").agg(F.min_by(F.struct("_b", (F.col("_n1") - F.col("_cum") + F.col("_c"))
                                                      .alias("need")), F.col("_b")).alias("bd"))
                .select("sim", F.col("bd._b").alias("_bb"), F.col("bd.need").alias("_need")))
    # one row per simulation: the broadcast side is bounded by the parameter
    x = x.join(F.broadcast(boundary), "sim", "left")
    base = [key, "outcome", *confounders, "sim"]
    plain = x.where(F.col("_bb").isNull() | (F.col("_b") != F.col("_bb"))).select(
        *base, F.when(F.col("_bb").isNull(), F.lit(0))
        .otherwise((F.col("_b") < F.col("_bb")).cast("int")).alias("treatment"))
    edge = x.where(F.col("_b") == F.col("_bb"))
    rank = F.row_number().over(Window.partitionBy("sim", "_b").orderBy("_h", key))
    edge = edge.select(*base, (rank <= F.col("_need")).cast("int").alias("treatment"))
    return plain.unionByName(edge)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good units among ``draws`` without replacement, for any population size.

    Ratio of uniforms with the log of the probabilities from ``lgamma`` (numpy's own
    generator refuses populations of 10^9 and more).
    """
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    if low >= high:
        return low
    mean = draws * (good / total)
    spread = math.sqrt(mean * (bad / total) * ((total - draws) / max(total - 1, 1)) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)

    def log_probability(k: int) -> float:
        return -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(draws - k + 1)
                 + math.lgamma(bad - draws + k + 1))
    mode = (draws + 1) * (good + 1) // (total + 2)
    top = log_probability(min(max(mode, low), high))
    while True:
        u, v = 1 - rng.random(), rng.random()
        x = mean + 0.5 + width * (v - 0.5) / u
        if low <= x < high + 1 and 2 * math.log(u) <= log_probability(int(x)) - top:
            return int(x)


def grouped_placebo_cells(cells: DataFrame, simulations: int = SIMULATIONS, seed: int = SEED,
                          confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """Placebo cell tables (keys ``sim``) drawn from the observed cells."""
    from liftlens.session import ship_package
    ship_package(cells.sparkSession)
    conf = list(confounders)
    reps = cells.select(*conf, "n", "n1", "y", F.explode(F.sequence(F.lit(0), F.lit(simulations - 1))).alias("sim"))
    schema = T.StructType([reps.schema["sim"], *[reps.schema[c] for c in conf],
                           T.StructField("n", T.LongType()), T.StructField("n1", T.LongType()),
                           T.StructField("y", T.LongType()), T.StructField("y1", T.LongType())])

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(conf, kind="mergesort").reset_index(drop=True)   # order-free draws
        rng = np.random.default_rng([seed, int(pdf["sim"].iloc[0])])
        out = pdf[["sim", *conf]].copy()
        left, treated = int(pdf["n"].sum()), int(pdf["n1"].sum())
        n1, y1 = [], []
        for n, y in zip(pdf["n"].astype(int), pdf["y"].astype(int)):
            # labels that fall into this cell, then how many of its outcomes they meet
            left -= n
            n1.append(hypergeometric(rng, n, left, treated))
            treated -= n1[-1]
            y1.append(hypergeometric(rng, y, n - y, n1[-1]))
        out["n"], out["n1"], out["y"], out["y1"] = pdf["n"], n1, pdf["y"], y1
        return out
    return reps.groupBy("sim").applyInPandas(draw, schema)


def grouped_placebo(cells: DataFrame, simulations: int = SIMULATIONS, seed: int = SEED, model: str = "saturated",
                    clip=DEFAULT_CLIP, estimator: str = WEIGHTING,
                    confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """(sim, ate) from the observed cells alone: no pass over sessions, cost independent of their number."""
    return _estimates(grouped_placebo_cells(cells, simulations, seed, confounders), model, clip, estimator, confounders)


def _estimates(cells: DataFrame, model: str, clip, estimator: str, confounders: Sequence[str]) -> DataFrame:
    scored = score_cells(cells, model=model, confounders=confounders, keys=["sim"])
    return method_estimates(scored, ["sim"], (estimator,), clip).drop("method")


def placebo_estimates(frame: DataFrame, simulations: int = SIMULATIONS, seed: int = SEED,
                      model: str = "saturated", clip=DEFAULT_CLIP, buckets: int = BUCKETS,
                      confounders: Sequence[str] = CONFOUNDERS, method: str = "rows",
                      estimator: str = WEIGHTING) -> DataFrame:
    """(sim, ate) under permuted treatment, propensity refitted per simulation, for any estimator.

    ``rows`` permutes unit by unit (hash order, SQL-checkable); ``grouped``
    draws the permuted cell tables directly (cost independent of units).
    """
    if method == "grouped":
        return grouped_placebo(build_cells(frame, confounders), simulations, seed, model, clip, estimator, confounders)
    if method != "rows":
        raise ValueError("method must be 'rows' or 'grouped'")
    permuted = placebo_frame(frame, simulations, seed, buckets, confounders)
    return _estimates(build_cells(permuted, confounders, keys=["sim"]), model, clip, estimator, confounders)


def placebo_effect(sim_estimates: DataFrame) -> DataFrame:
    """The refuter's new effect: mean placebo ATE over simulations."""
    return sim_estimates.agg(F.avg("ate").alias("placebo_effect"),
                             F.stddev_samp("ate").alias("placebo_sd"),
                             F.count(F.lit(1)).alias("simulations"))
