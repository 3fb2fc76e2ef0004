"""Bootstrap confidence interval of the IPW estimate.

Poisson bootstrap: each session gets an independent Poisson(1) weight per
replicate, drawn from a hash of (session_key, replicate, seed).  Replicates are
generated inside the map tasks and aggregated straight to weighted confounder
cells (partial aggregation), so the shuffle carries (tasks x replicates x
cells) rows and no task ever holds a replicate's sessions.  The propensity
model is refitted per replicate (keys = replicate), then the percentile CI,
standard deviation and share of positive replicates are plain aggregates.

``method='grouped'`` draws the same distribution from the cells directly:
the total weight of m exchangeable units is Poisson(m), so one draw per
(cell, treatment, outcome, replicate) replaces m draws.  Cost is independent
of the number of sessions; it is exact in distribution but not draw-for-draw
equal to the row method (no SQL oracle).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.functions.hashing import DRAWS_PER_MD5, hash_key, hex32_uniform, poisson1
from liftlens.operators.causal.cells import CELL_STATS, build_cells
from liftlens.operators.causal.encode import CONFOUNDERS
from liftlens.operators.causal.estimators import DEFAULT_CLIP
from liftlens.operators.causal.propensity import score_cells
from liftlens.operators.causal.results import method_estimates
from liftlens.operators.reports import WEIGHTING

# Fixed values of the reference's bootstrap.
REPLICATES = 200
SEED = 42
ALPHA = 0.05


def replicate_ids(replicates: int):
    return F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")


def bootstrap_cells(frame: DataFrame, replicates: int = REPLICATES, seed: int = SEED,
                    confounders: Sequence[str] = CONFOUNDERS, key: str = "session_key") -> DataFrame:
    """Weighted cells per replicate; weight of (unit, replicate b) is Poisson(1) of
    32-bit slot b % 4 of md5('key|boot|b div 4|seed'): one hash serves four replicates."""
    blocks = -(-replicates // DRAWS_PER_MD5)
    rows = frame.select(key, "treatment", "outcome", *confounders,
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_blk"))
    # the digest is its own projection (read four times, so never inlined)
    rows = rows.withColumn("_md5", F.md5(hash_key(F.col(key), F.lit("boot"), F.col("_blk"), F.lit(seed))))
    slots = F.array(*[F.substring("_md5", 8 * i + 1, 8) for i in range(DRAWS_PER_MD5)])
    rows = rows.select(key, "treatment", "outcome", *confounders, "_blk",
                       F.posexplode(slots).alias("_slot", "_hex"))
    rows = rows.withColumn("replicate", F.col("_blk") * DRAWS_PER_MD5 + F.col("_slot"))
    rows = rows.where(F.col("replicate") < replicates)
    # the Poisson CASE chain reads the uniform 13 times: keep it materialised.
    # Zero weights are dropped after aggregation (a filter on the weight would
    # be pushed below the projection and evaluate the chain twice).
    rows = rows.withColumn("_u", hex32_uniform(F.col("_hex")))
    rows = rows.withColumn("_w", poisson1(F.col("_u")))
    return build_cells(rows, confounders, keys=["replicate"], weight="_w").where(F.col("n") > 0)


def grouped_bootstrap_cells(cells: DataFrame, replicates: int = REPLICATES, seed: int = SEED,
                            confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """Cells per replicate from the observed cells.

    A cell's four (treatment, outcome) groups have m exchangeable units each, so
    their total weight is Poisson(m).  One group of ``applyInPandas`` is one cell
    table (bounded by the encoding); its draws are one vectorised call, seeded by
    (seed, replicate) over the cells in sorted order.
    """
    from liftlens.session import ship_package
    ship_package(cells.sparkSession)
    conf = list(confounders)
    reps = cells.select(*conf, *CELL_STATS, replicate_ids(replicates))
    schema = T.StructType([reps.schema["replicate"], *[reps.schema[c] for c in conf],
                           *[T.StructField(c, T.LongType()) for c in CELL_STATS]])

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(conf, kind="mergesort").reset_index(drop=True)
        n, n1, y, y1 = (pdf[c].to_numpy(dtype=np.float64) for c in CELL_STATS)
        rng = np.random.default_rng([seed, int(pdf["replicate"].iloc[0])])
        w11, w10, w01, w00 = rng.poisson(np.stack([y1, n1 - y1, y - y1, n - n1 - y + y1]))
        out = pdf[["replicate", *conf]].copy()
        out["n"], out["n1"], out["y"], out["y1"] = w11 + w10 + w01 + w00, w11 + w10, w11 + w01, w11
        return out[out["n"] > 0]
    return reps.groupBy("replicate").applyInPandas(draw, schema)


def grouped_replicates(cells: DataFrame, replicates: int = REPLICATES, seed: int = SEED, model: str = "saturated",
                       clip=DEFAULT_CLIP, estimator: str = WEIGHTING,
                       confounders: Sequence[str] = CONFOUNDERS) -> DataFrame:
    """(replicate, ate) from the observed cells alone: no pass over sessions, cost independent of their number."""
    drawn = grouped_bootstrap_cells(cells, replicates, seed, confounders)
    return _estimates(drawn, model, clip, estimator, confounders)


def _estimates(cells: DataFrame, model: str, clip, estimator: str, confounders: Sequence[str]) -> DataFrame:
    scored = score_cells(cells, model=model, confounders=confounders, keys=["replicate"])
    return method_estimates(scored, ["replicate"], (estimator,), clip).drop("method")


def replicate_estimates(frame: DataFrame, replicates: int = REPLICATES, seed: int = SEED,
                        model: str = "saturated", clip=DEFAULT_CLIP, method: str = "grouped",
                        confounders: Sequence[str] = CONFOUNDERS, estimator: str = WEIGHTING) -> DataFrame:
    """(replicate, ate) with the propensity refitted in every replicate, for any estimator."""
    if method == "rows":
        return _estimates(bootstrap_cells(frame, replicates, seed, confounders), model, clip, estimator, confounders)
    if method == "grouped":
        return grouped_replicates(build_cells(frame, confounders), replicates, seed, model, clip, estimator, confounders)
    raise ValueError("method must be 'rows' or 'grouped'")


def bootstrap_ci(replicate_ates: DataFrame, point: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Percentile CI, SD and positive share over replicates, next to the point estimate.

    The point-estimate row is stacked under replicate -1 and everything is one
    aggregate (no join between the two single-row results).
    """
    lo, hi = alpha / 2, 1 - alpha / 2
    stacked = replicate_ates.select(F.col("replicate").cast("int").alias("_r"), "ate").unionByName(
        point.select(F.lit(-1).alias("_r"), "ate"))
    rep = F.when(F.col("_r") >= 0, F.col("ate"))
    out = stacked.agg(
        F.max(F.when(F.col("_r") < 0, F.col("ate"))).alias("ate"),
        F.percentile(rep, F.array(F.lit(lo), F.lit(hi))).alias("_q"),
        F.stddev_samp(rep).alias("sd"),
        F.avg((rep > 0).cast("double")).alias("share_positive"),
        F.count(rep).alias("replicates"))
    return out.select("ate", F.col("_q")[0].alias("ci_low"), F.col("_q")[1].alias("ci_high"),
                      "sd", "share_positive", "replicates")
