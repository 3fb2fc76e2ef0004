"""ATE estimators on scored confounder cells.

Input: a cell table with ``n, n1, y, y1`` and a propensity ``ps`` per cell,
optionally several tables stacked under ``keys``.  Output: one row per key.

Matching and stratification only need the *distinct scores* (units with the
same score are exchangeable), so their windows run over at most one row per
distinct score and key – never over sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftlens.operators.causal.cells import n0, y0

# The clip of the governed estimate, the library's own clip, units an arm needs in a stratum.
DEFAULT_CLIP = (0.001, 0.999)
LIBRARY_DEFAULT_CLIP = (0.05, 0.95)
MIN_PER_ARM = 10
# Parameter: with num_strata="auto" the search for a number of strata starts here.
STRATA_START = 50


def clipped(ps: Column, lo: float | Column, hi: float | Column) -> Column:
    lo = F.lit(lo) if isinstance(lo, (int, float)) else lo
    hi = F.lit(hi) if isinstance(hi, (int, float)) else hi
    return F.least(F.greatest(ps, lo), hi)


def naive_difference(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """P(y | t=1) - P(y | t=0); a missing arm gives NULL."""
    agg = cells.groupBy(*keys).agg(F.sum("n").alias("_n"), F.sum("n1").alias("_n1"),
                                   F.sum("y").alias("_y"), F.sum("y1").alias("_y1"))
    return agg.select(*keys, (F.try_divide(F.col("_y1"), F.col("_n1"))
                              - F.try_divide(F.col("_y") - F.col("_y1"), F.col("_n") - F.col("_n1"))
                              ).alias("ate"))


def ipw_ate(scored: DataFrame, keys: Sequence[str] = (), clip=DEFAULT_CLIP,
            lo_col: str | None = None, hi_col: str | None = None) -> DataFrame:
    """Normalised (Hajek) inverse-propensity weighting with clipped scores.

    ATE = sum(y1/p)/sum(n1/p) - sum(y0/(1-p))/sum(n0/(1-p)) over cells.
    Without a clip (0, 1) a cell's missing arm has weight 0/0 and adds nothing.
    ``lo_col``/``hi_col`` take the clip from columns (clip grids, C12).
    """
    lo = F.col(lo_col) if lo_col else clip[0]
    hi = F.col(hi_col) if hi_col else clip[1]
    p = clipped(F.col("ps"), lo, hi)
    agg = scored.groupBy(*keys).agg(
        F.sum(F.try_divide(F.col("y1"), p)).alias("_a"), F.sum(F.try_divide(F.col("n1"), p)).alias("_b"),
        F.sum(F.try_divide(y0(), 1 - p)).alias("_c"), F.sum(F.try_divide(n0(), 1 - p)).alias("_d"))
    return agg.select(*keys, (F.try_divide(F.col("_a"), F.col("_b"))
                              - F.try_divide(F.col("_c"), F.col("_d"))).alias("ate"))


def _score_table(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return scored.groupBy(*keys, "ps").agg(
        F.sum("n").alias("n"), F.sum("n1").alias("n1"), F.sum("y1").alias("y1"),
        F.sum(y0()).alias("y0"))


def _nearest(prev: Column, nxt: Column) -> Column:
    """Closer of two neighbours (structs with field ``s``); the lower one wins ties."""
    ps = F.col("ps")
    return (F.when(prev.isNull(), nxt).when(nxt.isNull(), prev)
            .when(ps - prev["s"] <= nxt["s"] - ps, prev).otherwise(nxt))


def matching_ate(scored: DataFrame, keys: Sequence[str] = (), tie_policy: str = "mean",
                 seed: int = 42) -> DataFrame:
    """1-nearest-neighbour matching on the score in both directions.

    ATT matches each treated unit to the nearest control score, ATC each
    control to the nearest treated score; ATE = (ATT*N1 + ATC*N0) / N; equal
    distance picks the lower score.  Units tied at the matched score:

    * ``mean`` – contribute their mean outcome (deterministic, stable);
    * ``seeded`` – one unit of the tied group is picked (by a hash of the
      score's rank, arm and ``seed``) and every unit matched to that score gets
      its outcome, as a nearest-neighbour search that resolves ties the same
      way for identical queries does.  Varying ``seed`` shows how unstable
      matching is when scores have few distinct values.

    Returns ``ate``, ``att``, ``atc``.
    """
    if tie_policy not in ("mean", "seeded"):
        raise ValueError("tie_policy must be 'mean' or 'seeded'")
    st = _score_table(scored, keys).withColumn("n0", F.col("n") - F.col("n1"))
    order = Window.partitionBy(*keys).orderBy("ps")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    m0, m1 = F.col("y0") / F.col("n0"), F.col("y1") / F.col("n1")
    if tie_policy == "seeded":
        from liftlens.functions.hashing import uniform
        st = st.withColumn("_rk", F.row_number().over(order))
        # the picked unit has outcome 1 with probability (tied positives / tied units)
        m0 = (uniform(F.lit("match"), F.lit("c"), F.col("_rk"), F.lit(seed)) < m0).cast("double")
        m1 = (uniform(F.lit("match"), F.lit("t"), F.col("_rk"), F.lit(seed)) < m1).cast("double")
    ctrl = F.when(F.col("n0") > 0, F.struct(F.col("ps").alias("s"), m0.alias("m")))
    trt = F.when(F.col("n1") > 0, F.struct(F.col("ps").alias("s"), m1.alias("m")))
    nn0 = _nearest(F.last(ctrl, ignorenulls=True).over(before), F.first(ctrl, ignorenulls=True).over(after))
    nn1 = _nearest(F.last(trt, ignorenulls=True).over(before), F.first(trt, ignorenulls=True).over(after))
    matched = st.select(*keys, "n1", "n0",
                        F.when(F.col("n1") > 0, F.col("y1") - F.col("n1") * nn0["m"]).alias("att_part"),
                        F.when(F.col("n0") > 0, F.col("n0") * nn1["m"] - F.col("y0")).alias("atc_part"))
    agg = matched.groupBy(*keys).agg(
        F.sum("n1").alias("_n1"), F.sum("n0").alias("_n0"),
        F.sum("att_part").alias("_att"), F.sum("atc_part").alias("_atc"))
    both = (F.col("_n1") > 0) & (F.col("_n0") > 0)
    return agg.select(
        *keys,
        F.when(both, (F.col("_att") + F.col("_atc")) / (F.col("_n1") + F.col("_n0"))).alias("ate"),
        F.when(both, F.col("_att") / F.col("_n1")).alias("att"),
        F.when(both, F.col("_atc") / F.col("_n0")).alias("atc"),
    )


def strata_candidates(start: int = STRATA_START) -> list[int]:
    out, s = [], start
    while s >= 1:
        out.append(s)
        s //= 2
    return out


def stratified_ate(scored: DataFrame, keys: Sequence[str] = (), num_strata: int | str = "auto",
                   min_per_arm: int = MIN_PER_ARM, start: int = STRATA_START) -> DataFrame:
    """Stratification on the propensity score.

    Stratum of a unit = round_half_even(average_rank(ps) / N * S), so units
    with the same score share a stratum.  Strata with ``min_per_arm`` or
    fewer units in either arm are dropped; ATE = size-weighted mean of the
    within-stratum differences over kept strata.  ``num_strata='auto'``
    tries S = start, start/2, ... and keeps the first S for which at least
    half the strata survive (all candidates in one pass, no driver loop).
    Returns ``ate``, ``num_strata``, ``kept_strata``.
    """
    st = _score_table(scored, keys)
    order = Window.partitionBy(*keys).orderBy("ps")
    cum_before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(*keys))
    ranked = st.select(*keys, "n", "n1", "y1", "y0",
                       (cum_before + (F.col("n") + 1) / 2.0).alias("_rank"), total.alias("_N"))
    cands = strata_candidates(start) if num_strata == "auto" else [int(num_strata)]
    ranked = ranked.withColumn("S", F.explode(F.array(*[F.lit(s) for s in cands])))
    ranked = ranked.withColumn("stratum", F.bround(F.col("_rank") / F.col("_N") * F.col("S"), 0))
    strata = ranked.groupBy(*keys, "S", "stratum").agg(
        F.sum("n1").alias("T"), F.sum(F.col("n") - F.col("n1")).alias("C"),
        F.sum("y1").alias("Y1"), F.sum("y0").alias("Y0"))
    kept = F.least("T", "C") > min_per_arm
    size = F.col("T") + F.col("C")
    effect = F.col("Y1") / F.col("T") - F.col("Y0") / F.col("C")
    per_s = strata.groupBy(*keys, "S").agg(
        F.count_if(kept).alias("kept_strata"),
        F.try_divide(F.sum(F.when(kept, effect * size)), F.sum(F.when(kept, size))).alias("ate"))
    if num_strata != "auto":
        return per_s.select(*keys, "ate", F.col("S").alias("num_strata"), "kept_strata")
    ok = F.col("kept_strata") >= 0.5 * F.col("S")
    # largest candidate that keeps half its strata; the smallest one otherwise
    choose = F.coalesce(F.max_by(F.struct("ate", "S", "kept_strata"), F.when(ok, F.col("S"))),
                        F.min_by(F.struct("ate", "S", "kept_strata"), F.col("S")))
    return per_s.groupBy(*keys).agg(choose.alias("_c")).select(
        *keys, F.col("_c.ate").alias("ate"), F.col("_c.S").alias("num_strata"),
        F.col("_c.kept_strata").alias("kept_strata"))


def row_level_ipw(frame: DataFrame, scored: DataFrame, confounders: Sequence[str],
                  clip=DEFAULT_CLIP, treatment: str = "treatment", outcome: str = "outcome") -> DataFrame:
    """The same Hajek estimator computed unit by unit.

    Each session picks up its cell's score through a join with the cell table
    (at most prod(levels) rows); Spark broadcasts it by its size in bytes.
    """
    p = clipped(F.col("ps"), *clip)
    t, y = F.col(treatment), F.col(outcome)
    rows = frame.join(scored.select(*confounders, "ps"), list(confounders))
    agg = rows.agg(F.sum(F.try_divide(t * y, p)).alias("_a"), F.sum(F.try_divide(t, p)).alias("_b"),
                   F.sum(F.try_divide((1 - t) * y, 1 - p)).alias("_c"), F.sum(F.try_divide(1 - t, 1 - p)).alias("_d"))
    return agg.select((F.try_divide(F.col("_a"), F.col("_b"))
                       - F.try_divide(F.col("_c"), F.col("_d"))).alias("ate"))


def clip_sensitivity(scored: DataFrame, clips: Sequence[tuple[float, float]],
                     keys: Sequence[str] = ()) -> DataFrame:
    """IPW for each clip in a grid; the grid is exploded, not joined."""
    grid = F.explode(F.array(*[F.struct(F.lit(float(lo)).alias("clip_lo"), F.lit(float(hi)).alias("clip_hi"))
                               for lo, hi in clips]))
    g = scored.withColumn("_clip", grid).select("*", "_clip.clip_lo", "_clip.clip_hi").drop("_clip")
    return ipw_ate(g, keys=[*keys, "clip_lo", "clip_hi"], lo_col="clip_lo", hi_col="clip_hi")
