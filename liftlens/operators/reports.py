"""Channel report, estimate views, dashboard queries and exploration (F8-F11,
A8-A15, W1, U1, K2-K4, R1-R7, E1-E4).

Everything here is a lazy DataFrame over the session mart or the estimates
table; Catalyst inlines these "views" and pushes filters/columns into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.functions.channels import channel_of
from liftlens.functions.money import money

# The method flagged as an outlier and its caveat text.
MATCHING = "propensity_score_matching"
WEIGHTING = "propensity_score_weighting"
STRATIFICATION = "propensity_score_stratification"
NAIVE = "naive_correlation"
MATCHING_CAVEAT = (
    "Known outlier — with a small treated share (~4% of sessions) and purely "
    "categorical confounders, the propensity model produces only a handful of "
    "distinct scores, so nearest-neighbor matching picks arbitrarily among "
    "thousands of tied controls. Weighting and stratification agree near zero; "
    "use propensity_score_weighting."
)
KIND_OUTLIER = "causal (backdoor-adjusted) — KNOWN OUTLIER, see caveat"
KIND_GOVERNED = "causal (backdoor-adjusted) — governed estimate"
KIND_NAIVE = "raw correlation (no adjustment)"


# --- channel performance (A8-A11, F8) and dashboard rollups (R5-R7) --------

def channel_performance(sessions: DataFrame) -> DataFrame:
    """``rpt_channel_performance``: day x channel x first-touch medium."""
    n = F.count(F.lit(1))
    conv = F.count_if(F.col("converted"))
    return (sessions
            .groupBy("session_date", channel_of("first_touch_medium").alias("channel"),
                     "first_touch_medium")
            .agg(n.alias("sessions"),
                 conv.alias("conversions"),
                 F.try_divide(conv, n).alias("conversion_rate"),
                 F.round(F.sum(money("session_revenue_usd")), 2).cast("double").alias("revenue_usd")))


def channel_daily_sessions(channel: DataFrame) -> DataFrame:
    """Sessions by day x channel (re-aggregated over medium)."""
    return channel.groupBy("session_date", "channel").agg(F.sum("sessions").alias("sessions"))


def channel_daily_rate(channel: DataFrame) -> DataFrame:
    """Conversion rate by day x channel as a ratio of sums, never a mean of rates."""
    return (channel.groupBy("session_date", "channel")
            .agg(F.sum("conversions").alias("conversions"), F.sum("sessions").alias("sessions"))
            .withColumn("conversion_rate", F.try_divide(F.col("conversions"), F.col("sessions"))))


def channel_detail(channel: DataFrame) -> DataFrame:
    """Channel x medium detail over all days, sorted by sessions desc."""
    return (channel.groupBy("channel", "first_touch_medium")
            .agg(F.sum("sessions").alias("sessions"),
                 F.sum("conversions").alias("conversions"),
                 F.round(F.sum(money("revenue_usd")), 2).cast("double").alias("revenue_usd"))
            .withColumn("conversion_rate", F.try_divide(F.col("conversions"), F.col("sessions")))
            .select("channel", "first_touch_medium", "sessions", "conversions",
                    "conversion_rate", "revenue_usd")
            .orderBy(F.desc("sessions"), "channel", "first_touch_medium"))


# --- estimate views (R1-R4, W1, U1, F9-F11, A12) ---------------------------

LOAD_SEQ = "load_seq"   # number of the load that wrote an estimate row


def latest_estimates(estimates: DataFrame, matching_caveat: str = MATCHING_CAVEAT) -> DataFrame:
    """``fct_causal_estimates``: newest row per method plus derived columns.

    ``matching_caveat`` states facts about the data, so pass one's own for other data.
    ``row_number() = 1`` per method is planned as a WindowGroupLimit (partial
    top-1 before the shuffle), the Spark form of QUALIFY.
    """
    # of two runs of one day the one loaded later wins
    again = [F.desc(LOAD_SEQ)] if LOAD_SEQ in estimates.columns else []
    w = Window.partitionBy("method").orderBy(F.desc("run_at"), *again)
    top = estimates.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    is_matching = F.col("method") == MATCHING
    return top.select(
        "method", "ate", "naive_difference",
        (F.col("naive_difference") - F.col("ate")).alias("implied_selection_bias"),
        is_matching.alias("is_outlier"),
        F.when(is_matching, F.lit(matching_caveat)).alias("method_caveat"),
        "n_sessions", "n_paid", "n_converted", "data_start", "data_end", "run_at",
        F.to_date("run_at").alias("run_date"),
    )


def causal_summary(latest: DataFrame) -> DataFrame:
    """``rpt_causal_summary``: one row per estimate plus the naive row.

    The naive row takes all its fields from the single newest estimate row
    (``max_by`` of one struct) instead of independent ``any_value`` picks, so
    its fields always come from the same run.  A global aggregate returns one
    row even over an empty input, as the reference's does.
    """
    per_method = latest.select(
        F.col("method").alias("estimate"),
        F.col("ate").alias("conversion_lift"),
        F.when(F.col("is_outlier"), F.lit(KIND_OUTLIER)).otherwise(F.lit(KIND_GOVERNED))
         .alias("estimate_kind"),
        "is_outlier", "method_caveat", "n_sessions", "data_start", "data_end", "run_at",
    )
    pick = F.max_by(F.struct("naive_difference", "n_sessions", "data_start", "data_end", "run_at",
                             "method"),
                    F.struct("run_at", "method"))
    naive = latest.agg(pick.alias("p")).select(
        F.lit(NAIVE).alias("estimate"),
        F.col("p.naive_difference").alias("conversion_lift"),
        F.lit(KIND_NAIVE).alias("estimate_kind"),
        F.lit(False).alias("is_outlier"),
        F.lit(None).cast("string").alias("method_caveat"),
        F.col("p.n_sessions").alias("n_sessions"),
        F.col("p.data_start").alias("data_start"),
        F.col("p.data_end").alias("data_end"),
        F.col("p.run_at").alias("run_at"),
    )
    return per_method.unionByName(naive)


def scorecards(summary: DataFrame) -> DataFrame:
    """Naive lift, governed lift and session count as one row."""
    return summary.agg(
        F.max(F.when(F.col("estimate") == NAIVE, F.col("conversion_lift"))).alias("naive_lift"),
        F.max(F.when(F.col("estimate") == WEIGHTING, F.col("conversion_lift"))).alias("causal_lift"),
        F.max(F.when(F.col("estimate") == WEIGHTING, F.col("n_sessions"))).alias("n_sessions"),
    )


def estimator_comparison(summary: DataFrame) -> DataFrame:
    """Every estimate in percentage points, flagged outlier included."""
    return summary.select("estimate", (F.col("conversion_lift") * 100).alias("lift_pp"),
                          "estimate_kind", "is_outlier", "method_caveat")


# --- exploration (E1-E4, A13-A15, K2, K4) ----------------------------------

MODEL_COLUMNS = ("is_paid", "converted", "device_category", "geo_country",
                 "is_new_user", "session_date")


def table_shape(sessions: DataFrame) -> DataFrame:
    """Rows, columns and date range of the loaded frame."""
    return sessions.agg(F.count(F.lit(1)).alias("n_rows"),
                        F.lit(len(MODEL_COLUMNS)).cast("bigint").alias("n_columns"),
                        F.min("session_date").alias("date_start"),
                        F.max("session_date").alias("date_end"))


def table_shape_from_statistics(statistics: DataFrame) -> DataFrame:
    """E1 from a written mart's statistics (``table_statistics`` with the range of ``session_date``)."""
    return statistics.select(F.col("num_rows").alias("n_rows"), F.lit(len(MODEL_COLUMNS)).cast("bigint").alias("n_columns"),
                             F.col("min_session_date").alias("date_start"), F.col("max_session_date").alias("date_end"))


def null_profile_from_statistics(statistics: DataFrame, columns=MODEL_COLUMNS) -> DataFrame:
    """E2 from a written mart's statistics (``table_statistics`` with the NULLs of ``columns``)."""
    pairs = ", ".join(f"'{c}', `nulls_{c}`" for c in columns)
    return statistics.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_count)")


def null_profile(sessions: DataFrame, columns=MODEL_COLUMNS) -> DataFrame:
    """NULL count per column, one pass, long form (column_name, null_count)."""
    counts = sessions.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_count)")


def treatment_distribution(sessions: DataFrame) -> DataFrame:
    """Arm counts (NULL excluded like value_counts), shares, imbalance ratio."""
    n = F.count(F.lit(1))
    paid = F.count_if(F.col("is_paid"))
    organic = F.count_if(~F.col("is_paid"))
    conv = F.count_if(F.col("converted"))
    return sessions.agg(
        n.alias("n_sessions"), organic.alias("n_control"), paid.alias("n_paid"),
        F.try_divide(paid, n).alias("share_paid"),
        F.try_divide(organic, paid).alias("imbalance_ratio"),
        conv.alias("n_converted"), F.try_divide(conv, n).alias("share_converted"),
    )


def arm_rates(frame: DataFrame, treatment: str = "treatment", outcome: str = "outcome") -> DataFrame:
    """Per-arm size, conversions and rate on the encoded model frame."""
    return (frame.groupBy(F.col(treatment).alias("treatment"))
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.sum(outcome).cast("bigint").alias("conversions"),
                 F.avg(outcome).alias("conversion_rate")))


def preview(frame: DataFrame, n: int = 5, order_by=("session_key",)) -> DataFrame:
    """K4: first ``n`` rows in a stated order (a head needs an order in Spark)."""
    return frame.orderBy(*order_by).limit(n)
