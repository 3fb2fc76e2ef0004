"""The model chain as lazy DataFrames over a testdata folder.

raw_events -> staging -> sessions -> channel are plans only: Catalyst fuses the
chain and prunes columns back to the parquet scan.  ``frame``, ``cells`` and
``history`` read an intermediate several times and therefore write it (session
columns, raw cells, estimates) below the shared folder while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.operators.flatten import flatten_events
from liftlens.operators.reports import channel_performance
from liftlens.operators.sessions import sessionize
from liftlens.sources.ga4_adapter import ga4_events, with_items
from liftlens.sources.testdata import table


def raw_events(spark: SparkSession, sf: str, ds: str | None = None) -> DataFrame:
    """GA4-shaped raw events; ``ds`` (YYYYMMDD) reads one day's shard only."""
    events = table(spark, sf, "events")
    if ds is not None:
        # a range predicate on ``ts`` is pushed into the parquet scan
        day = F.to_timestamp_ntz(F.lit(ds), F.lit("yyyyMMdd"))
        events = events.where((F.col("ts") >= day) & (F.col("ts") < F.timestamp_add("DAY", F.lit(1), day)))
    return ga4_events(events)


def staging(spark: SparkSession, sf: str, ds: str | None = None) -> DataFrame:
    return flatten_events(raw_events(spark, sf, ds))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return sessionize(staging(spark, sf))


def channel(spark: SparkSession, sf: str) -> DataFrame:
    return channel_performance(sessions(spark, sf))


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events with their items."""
    return with_items(raw_events(spark, sf), table(spark, sf, "lineitem"))


# --- causal chain: model frame -> confounder cells -> scores ---------------

NULL_TREATMENT = "control"   # testdata has NULL is_paid sessions (T1)


def frame(spark: SparkSession, sf: str, null_treatment: str = NULL_TREATMENT) -> DataFrame:
    """Per-session model frame over the *written* session mart.

    ``model_frame`` reads sessions twice (top-N countries, then the frame);
    over a lazy plan each read would redo the event aggregation, so its seven
    columns are written once and both reads scan them.
    """
    from liftlens.operators.causal.encode import model_frame
    from liftlens.session import materialize
    mart = sessions(spark, sf).select("session_key", "session_date", "is_paid", "converted", "is_new_user",
                                      "device_category", "geo_country")
    return model_frame(materialize(mart, "sessions"), null_treatment=null_treatment)


def cells(spark: SparkSession, sf: str, keys=(), null_treatment: str = NULL_TREATMENT) -> DataFrame:
    """Confounder cells in one pass over the events (no per-session frame)."""
    from liftlens.operators.causal.encode import encoded_cells
    return encoded_cells(sessions(spark, sf), keys=keys, null_treatment=null_treatment)


def scored(spark: SparkSession, sf: str, model: str = "saturated") -> DataFrame:
    from liftlens.operators.causal.propensity import score_cells
    return score_cells(cells(spark, sf), model=model)


def history(spark: SparkSession, sf: str, model: str = "saturated", digits: int = 9,
            last_only: bool = False, stg: DataFrame | None = None) -> DataFrame:
    """Estimates of every daily run (one pass over the events, no mart write).

    Rounded to ``digits`` here, where two engines are compared; the library stores them as computed.
    """
    from liftlens.operators.causal.history import estimate_history
    return rounded(estimate_history(staging(spark, sf) if stg is None else stg, model=model, null_treatment=NULL_TREATMENT,
                                    last_only=last_only), digits)


def rounded(estimates: DataFrame, digits: int = 9) -> DataFrame:
    return estimates.withColumns({c: F.round(c, digits) for c in ("ate", "naive_difference") if c in estimates.columns})


def latest(spark: SparkSession, sf: str, last_only: bool = True, stg: DataFrame | None = None) -> DataFrame:
    """Newest row per method; the views need no run but the last."""
    from liftlens.operators.reports import latest_estimates
    return latest_estimates(history(spark, sf, last_only=last_only, stg=stg))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    from liftlens.operators.reports import causal_summary
    return causal_summary(latest(spark, sf))


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    from liftlens.operators.causal.star import order_cells as build
    return build(*(table(spark, sf, t) for t in ("orders", "customer", "nation", "lineitem")))
