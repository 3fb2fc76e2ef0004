"""Estimates of every daily run: the run of day d sees the events dated <= d and no others.

A session is not final on its first day: later events can make it paid, converted or new,
and can change which device and country it reports.  From the per-day partials of a session
follow its versions, each valid from one of its days to the day before its next one.  A
version counts +1 in its cell on its first day and -1 on the day that ends it.  The sums of
these differences per (cell, day) are small; their running sum per cell over the days is the
cell table of each run, and the top countries are ranked per run.  No session is repeated for
every later day, and no window spans more than one session or one cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.operators.causal.cells import CELL_STATS, merge_cells, run_stats
from liftlens.operators.causal.encode import (CONFOUNDERS, OTHER_COUNTRY, TOP_N_COUNTRIES, UNKNOWN_DEVICE, as_int)
from liftlens.operators.causal.estimators import DEFAULT_CLIP
from liftlens.operators.causal.propensity import score_cells
from liftlens.operators.causal.results import ALL_METHODS, assemble, method_estimates
from liftlens.operators.sessions import SESSION_KEYS, session_partials
from liftlens.session import materialize

RAW_KEYS = ("is_new_user", "device", "country")


def session_versions(stg: DataFrame) -> DataFrame:
    """(session, state, valid_from, valid_to): one row per day on which a session has events.

    ``valid_to`` is exclusive, NULL for the last version.
    """
    own = Window.partitionBy(*SESSION_KEYS).orderBy("p_date")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return session_partials(stg).select(
        *SESSION_KEYS, F.col("p_date").alias("valid_from"), F.lead("p_date").over(own).alias("valid_to"),
        F.min("p_date").over(upto).alias("session_date"),
        F.bool_or("p_paid").over(upto).alias("is_paid"), F.bool_or("p_converted").over(upto).alias("converted"),
        F.bool_or("p_new_user").over(upto).alias("is_new_user"),
        F.min("p_device").over(upto).alias("device_category"), F.min("p_geo").over(upto).alias("geo_country"))


def run_cells(stg: DataFrame, top_n: int = TOP_N_COUNTRIES, null_treatment: str = "error",
              last_only: bool = False) -> DataFrame:
    """Confounder cells of every run (or the last): ``run_date``, confounders, n, n1, y, y1, data_start, data_end."""
    versions = session_versions(stg)
    if null_treatment == "drop":
        versions = versions.where(F.col("is_paid").isNotNull())
    state = versions.select(
        "valid_from", "valid_to", "session_date",
        as_int("is_paid", "control" if null_treatment == "control" else "error").alias("t"),
        as_int("converted").alias("o"), as_int("is_new_user").alias("is_new_user"),
        F.coalesce(F.col("device_category"), F.lit(UNKNOWN_DEVICE)).alias("device"),
        F.col("geo_country").alias("country"))
    steps = F.array(F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("sign")),
                    F.struct(F.col("valid_to").alias("day"), F.lit(-1).alias("sign")))
    changes = state.withColumn("step", F.explode(steps)).where(F.col("step.day").isNotNull())
    sign = F.col("step.sign")
    begins = F.when(F.col("valid_from") == F.col("session_date"), F.col("session_date"))
    daily = changes.groupBy(F.col("step.day").alias("day"), *RAW_KEYS).agg(
        F.sum(sign).alias("n"), F.sum(sign * F.col("t")).alias("n1"), F.sum(sign * F.col("o")).alias("y"),
        F.sum(sign * F.col("t") * F.col("o")).alias("y1"), F.max(F.when(sign > 0, begins)).alias("begun"))
    # days x cells rows, read twice
    daily = materialize(daily, "cell-changes")
    # the calendar: one row per day
    span = daily.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("run_date"))
    begun = daily.groupBy(F.col("day").alias("run_date")).agg(F.max("begun").alias("begun"))
    so_far = Window.orderBy("run_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dates = calendar.join(begun, "run_date", "left").select(
        "run_date", F.min("begun").over(so_far).alias("data_start"), F.max("begun").over(so_far).alias("data_end"))
    last = span.first()["b"]
    cell = Window.partitionBy(*RAW_KEYS).orderBy("day")
    sums = [F.sum(c).over(cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c) for c in CELL_STATS]
    until = F.coalesce(F.date_sub(F.lead("day").over(cell), 1), F.lit(last).cast("date"))
    standing = daily.select(*RAW_KEYS, *sums, F.col("day").alias("since"), until.alias("until"))
    if last_only:
        standing = standing.where(F.col("until") == F.lit(last)).withColumn("since", F.col("until"))
    raw = standing.where(F.col("n") > 0).withColumn(
        "run_date", F.explode(F.sequence("since", "until", F.expr("INTERVAL 1 DAY")))).drop("since", "until")
    raw = materialize(raw, "run-cells")
    by_size = Window.partitionBy("run_date").orderBy(F.desc("sessions"), F.asc("country"))
    top = raw.where(F.col("country").isNotNull()).groupBy("run_date", "country").agg(F.sum("n").alias("sessions"))
    top = top.withColumn("place", F.row_number().over(by_size)).where(F.col("place") <= top_n).select(
        "run_date", "country", F.lit(True).alias("is_top"))
    mapped = raw.join(top, ["run_date", "country"], "left").withColumn(
        "geo", F.when(F.col("is_top"), F.col("country")).otherwise(F.lit(OTHER_COUNTRY)))
    return merge_cells(mapped, CONFOUNDERS, ["run_date"]).join(dates, "run_date")


def estimate_history(stg: DataFrame, methods: Sequence[str] = ALL_METHODS, model: str = "saturated", clip=DEFAULT_CLIP,
                     top_n: int = TOP_N_COUNTRIES, null_treatment: str = "error", last_only: bool = False) -> DataFrame:
    """Estimate rows of every daily run from the first to the last event date, or of the last one.

    ``run_at`` of the run for day d is midnight after d (UTC wall clock).
    """
    cells = run_cells(stg, top_n, null_treatment, last_only)
    scored = materialize(score_cells(cells, model=model, keys=["run_date"]), "run-scores")
    dates = scored.groupBy("run_date").agg(F.min("data_start").alias("data_start"), F.max("data_end").alias("data_end"))
    stats = run_stats(scored, ["run_date"]).join(dates, "run_date")
    est = method_estimates(scored, ["run_date"], methods, clip)
    run_at = F.timestamp_add("DAY", F.lit(1), F.col("run_date").cast("timestamp_ntz"))
    # runs x methods rows: written once, read by every report view
    return materialize(assemble(est, stats, ["run_date"], run_at), "estimates")
