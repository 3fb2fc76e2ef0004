"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with their oracle SQL.

Every query reads the testdata tables (or what Spark derives from them) in
full; parameters such as dates or seeds are features of the operator, never
row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.plans import oracle as O
from liftlens.plans import models as M

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- sources and flattening (S1 S2 S4 S6 F1-F6) ----------------------------

@register("flatten_events", O.stg_query())
def q_flatten_events(spark, sf):
    return M.staging(spark, sf)


ONE_SHARD = "20240115"


@register("flatten_one_shard", O.with_(
    O.RAW_EVENTS.replace("FROM events) e", f"FROM events) e WHERE strftime(e.ts, '%Y%m%d') = '{ONE_SHARD}'"),
    O.TYPED_EVENTS, O.STG, body=f"SELECT {O.STG_COLS} FROM stg"))
def q_flatten_one_shard(spark, sf):
    return M.staging(spark, sf, ds=ONE_SHARD)


@register("events_without_session", O.with_(*O.BASE[:2], body=(
    "SELECT event_date_key, event_date, event_at, event_name, user_pseudo_id, ga_session_id, "
    "traffic_medium, traffic_source, traffic_campaign, device_category, geo_country, "
    "purchase_revenue_usd, event_id FROM typed_events WHERE ga_session_id IS NULL")))
def q_events_without_session(spark, sf):
    from liftlens.operators.flatten import events_without_session
    return events_without_session(M.raw_events(spark, sf))


@register("param_lookup_multi", O.with_(O.RAW_EVENTS, body=(
    "SELECT event_id, "
    "list_filter(event_params, lambda p: p.key = 'ga_session_id')[1].value.int_value AS ga_session_id, "
    "list_filter(event_params, lambda p: p.key = 'engagement_k')[1].value.int_value AS engagement_k, "
    "list_filter(event_params, lambda p: p.key = 'page_title')[1].value.string_value AS page_title "
    "FROM raw_events")))
def q_param_lookup_multi(spark, sf):
    from liftlens.operators.flatten import lookup_params
    return lookup_params(M.raw_events(spark, sf), {
        "ga_session_id": ("ga_session_id", "int_value"),
        "engagement_k": ("engagement_k", "int_value"),
        "page_title": ("page_title", "string_value"),
    })


@register("shard_counts", O.with_(O.RAW_EVENTS, body=(
    "SELECT event_date AS shard, count(*) AS num_rows FROM raw_events GROUP BY event_date")))
def q_shard_counts(spark, sf):
    """S3 + S4: land every day's shard, then report rows per landed shard."""
    from liftlens.sources.shards import read_shards, shard_row_counts
    _, raw_root = _land_all(spark, sf)
    return shard_row_counts(read_shards(spark, raw_root))


@register("shard_counts_from_footers", ORACLE["shard_counts"])
def q_shard_counts_from_footers(spark, sf):
    """Rows per landed shard as the files' footers say, no row is read."""
    from liftlens.sources.statistics import partition_row_counts
    _, raw_root = _land_all(spark, sf)
    return partition_row_counts(spark, raw_root, "shard")


DECLARED_RANGE = (20240101, 20240129)


@register("partition_rejects", O.with_(*O.BASE, body=(
    f"SELECT {O.STG_COLS} FROM stg WHERE NOT (event_date_key >= {DECLARED_RANGE[0]} "
    f"AND event_date_key < {DECLARED_RANGE[1]})")))
def q_partition_rejects(spark, sf):
    from liftlens.sources.shards import split_partition_range
    _, rejects = split_partition_range(M.staging(spark, sf), *DECLARED_RANGE)
    return rejects


# --- items of events (G5) ----------------------------------------------------

def _r6_money(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("event_items", O.with_(*O.BASE, O.ITEMS, body=(
    "SELECT s.event_id, s.event_date, s.event_name, s.session_key, s.user_pseudo_id, i.item_pos, i.item_id, i.item_name, "
    "i.price_in_usd, i.quantity, i.item_revenue_usd "
    "FROM stg s LEFT JOIN items i ON i.event_id = s.event_id")))
def q_event_items(spark, sf):
    from liftlens.operators.items import flatten_items
    return flatten_items(M.raw_items(spark, sf))


@register("revenue_by_item", O.with_(*O.BASE, O.ITEMS, body=(
    "SELECT item_id, count(DISTINCT event_id) AS n_events, CAST(sum(quantity) AS BIGINT) AS quantity, "
    "round(CAST(sum(CAST(item_revenue_usd AS DECIMAL(38,12))) AS DOUBLE), 6) AS revenue_usd, "
    "count(*) FILTER (WHERE item_revenue_usd IS NULL) AS n_unpriced FROM items GROUP BY item_id")))
def q_revenue_by_item(spark, sf):
    from liftlens.operators.items import flatten_items, revenue_by_item
    return _r6_money(revenue_by_item(flatten_items(M.raw_items(spark, sf))), "revenue_usd")


@register("items_against_sessions", O.with_(*O.BASE, O.ITEMS, body=(
    "SELECT a.session_key, a.user_pseudo_id, a.n_purchases, coalesce(b.n_events, 0) AS n_events_with_items, "
    "coalesce(b.n, 0) AS n_items, round(CAST(a.r AS DOUBLE), 6) AS session_revenue_usd, "
    "round(CAST(coalesce(b.r, 0) AS DOUBLE), 6) AS item_revenue_usd, "
    "round(CAST(a.r - coalesce(b.r, 0) AS DOUBLE), 6) AS difference_usd FROM "
    "(SELECT session_key, user_pseudo_id, count(*) FILTER (WHERE event_name = 'purchase') AS n_purchases, "
    "sum(CAST(coalesce(purchase_revenue_usd, 0) AS DECIMAL(38,12))) AS r FROM stg GROUP BY ALL) a LEFT JOIN "
    "(SELECT session_key, user_pseudo_id, count(DISTINCT event_id) AS n_events, count(*) AS n, "
    "sum(CAST(coalesce(item_revenue_usd, 0) AS DECIMAL(38,12))) AS r FROM items GROUP BY ALL) b "
    "ON a.session_key IS NOT DISTINCT FROM b.session_key AND a.user_pseudo_id IS NOT DISTINCT FROM b.user_pseudo_id")))
def q_items_against_sessions(spark, sf):
    """The items' revenue of every session beside its revenue by A6."""
    from liftlens.operators.items import reconcile_items
    return _r6_money(reconcile_items(M.raw_items(spark, sf)), "session_revenue_usd", "item_revenue_usd", "difference_usd")


# --- sessions (A1-A7, X2, T2, T3) ------------------------------------------

SESSION_SQL = O.with_(*O.SESS, body="SELECT * FROM sessions")


@register("fct_sessions", SESSION_SQL)
def q_fct_sessions(spark, sf):
    return M.sessions(spark, sf)


@register("sessions_from_partials", SESSION_SQL)
def q_sessions_from_partials(spark, sf):
    from liftlens.operators.sessions import merge_partials, session_partials
    return merge_partials(session_partials(M.staging(spark, sf)))


@register("sessions_incremental", SESSION_SQL)
def q_sessions_incremental(spark, sf):
    """The mart after loads of some days each, and of days that were delivered short before."""
    from liftlens.plans.incremental import read_sessions, update_sessions
    from liftlens.session import fresh_dir
    root, stg, buckets = fresh_dir(spark, "mart"), M.staging(spark, sf), 4      # testdata days are small
    key = F.col("event_date_key")
    days = sorted(r[0] for r in stg.select(key).distinct().collect())      # one row per day
    early, late = days[: len(days) // 2 + 1], days[len(days) // 2:]
    update_sessions(stg.where(key.isin(early) & (F.col("event_id") % 3 > 0)), f"{root}/partials", f"{root}/mart", early, buckets)
    update_sessions(stg.where(key.isin(late)), f"{root}/partials", f"{root}/mart", late, buckets)
    update_sessions(stg.where(key.isin(early)), f"{root}/partials", f"{root}/mart", early, buckets)
    return read_sessions(spark, f"{root}/mart")


@register("sessions_first_touch", O.with_(*O.BASE, body=(
    "SELECT session_key, "
    "arg_min(event_id, (event_at, event_id)) FILTER (WHERE traffic_medium IS NOT NULL) AS medium_event_id, "
    "arg_min(event_id, (event_at, event_id)) FILTER (WHERE traffic_source IS NOT NULL) AS source_event_id, "
    "arg_min(event_id, (event_at, event_id)) FILTER (WHERE traffic_campaign IS NOT NULL) AS campaign_event_id, "
    "count(*) AS n_events FROM stg GROUP BY session_key")))
def q_sessions_first_touch(spark, sf):
    from liftlens.operators.sessions import first_touch_events
    return first_touch_events(M.staging(spark, sf))


@register("sessions_any_vs_first_touch", O.with_(*O.SESS, body=(
    f"SELECT is_paid, {O.CHANNEL_CASE} AS channel, count(*) AS sessions FROM sessions GROUP BY ALL")))
def q_sessions_any_vs_first_touch(spark, sf):
    from liftlens.operators.sessions import paid_by_channel
    return paid_by_channel(M.sessions(spark, sf))


# --- channel report (F8 A8-A11 R5-R7 K3) -----------------------------------

@register("channel_performance", O.with_(*O.CHAN, body="SELECT * FROM channel"))
def q_channel_performance(spark, sf):
    return M.channel(spark, sf)


@register("channel_daily_sessions", O.with_(*O.CHAN, body=(
    "SELECT session_date, channel, CAST(sum(sessions) AS BIGINT) AS sessions FROM channel GROUP BY ALL")))
def q_channel_daily_sessions(spark, sf):
    from liftlens.operators.reports import channel_daily_sessions
    return channel_daily_sessions(M.channel(spark, sf))


@register("channel_daily_rate", O.with_(*O.CHAN, body=(
    "SELECT session_date, channel, CAST(sum(conversions) AS BIGINT) AS conversions, "
    "CAST(sum(sessions) AS BIGINT) AS sessions, "
    "CAST(sum(conversions) AS DOUBLE) / sum(sessions) AS conversion_rate FROM channel GROUP BY ALL")))
def q_channel_daily_rate(spark, sf):
    from liftlens.operators.reports import channel_daily_rate
    return channel_daily_rate(M.channel(spark, sf))


@register("channel_detail", O.with_(*O.CHAN, body=(
    "SELECT channel, first_touch_medium, CAST(sum(sessions) AS BIGINT) AS sessions, "
    "CAST(sum(conversions) AS BIGINT) AS conversions, "
    "CAST(sum(conversions) AS DOUBLE) / sum(sessions) AS conversion_rate, "
    "CAST(round(sum(CAST(revenue_usd AS DECIMAL(38,12))), 2) AS DOUBLE) AS revenue_usd "
    "FROM channel GROUP BY ALL ORDER BY sessions DESC")))
def q_channel_detail(spark, sf):
    from liftlens.operators.reports import channel_detail
    return channel_detail(M.channel(spark, sf))


# --- causal: encoding, cells, estimators (K2 C1-C3 C5-C7 C10-C12) -----------

def _sub(sql: str) -> str:
    return f"SELECT * FROM ({sql})"


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    """Logit results: two engines' sums agree to about 1e-12, compared at 6 digits (after the 9 of all estimates)."""
    return _r9(df, *cols).withColumns({c: F.round(c, 6) for c in cols})


def _r9(df: DataFrame, *cols: str) -> DataFrame:
    """ATE-like outputs at 9 decimals (1e-7 percentage points), both engines."""
    return df.select(*[F.round(c, 9).alias(c) if c in cols else c for c in df.columns])


@register("top_countries", O.with_(*O.SESS, body=(
    "SELECT geo_country, count(*) AS sessions FROM sessions WHERE geo_country IS NOT NULL "
    "GROUP BY geo_country ORDER BY sessions DESC, geo_country ASC LIMIT 10")))
def q_top_countries(spark, sf):
    from liftlens.operators.causal.encode import top_levels
    return top_levels(M.sessions(spark, sf), "geo_country", 10)


@register("encoded_confounders", O.with_(*O.FRAMED, body=(
    "SELECT 'device_' || device AS confounder, count(*) AS n_ones, CAST(sum(treatment) AS BIGINT) AS n_treated "
    "FROM frame GROUP BY ALL UNION ALL "
    "SELECT regexp_replace(replace('geo_' || geo, ' ', '_'), '[<>]', '', 'g') AS confounder, count(*), "
    "CAST(sum(treatment) AS BIGINT) FROM frame GROUP BY ALL UNION ALL "
    "SELECT 'is_new_user', count(*), CAST(sum(treatment) AS BIGINT) FROM frame WHERE is_new_user = 1")))
def q_encoded_confounders(spark, sf):
    from liftlens.operators.causal.encode import confounder_columns
    return confounder_columns(M.frame(spark, sf))


_DUMMIES = ("long AS (SELECT session_key, treatment, outcome, is_new_user, unnest(['device_' || device, "
            "regexp_replace(replace('geo_' || geo, ' ', '_'), '[<>]', '', 'g')]) AS name FROM frame)")


@register("one_hot_frame", O.with_(*O.FRAMED, _DUMMIES, body=(
    "SELECT * FROM (PIVOT long ON name USING CAST(count(*) AS INTEGER) GROUP BY session_key, treatment, outcome, is_new_user)")))
def q_one_hot_frame(spark, sf):
    """The wide 0/1 frame, one column per level (the pivot has no session_date, so sessions are its rows)."""
    from liftlens.operators.causal.encode import one_hot
    return one_hot(M.frame(spark, sf))


@register("sparse_frame", O.with_(*O.FRAMED, body=(
    "SELECT f.session_key, f.treatment, f.outcome, CAST(1 + d.n + g.n AS INTEGER) AS n_columns, "
    "CASE WHEN f.is_new_user = 1 THEN '0,' ELSE '' END || d.at || ',' || (d.n + g.at) AS ones FROM frame f "
    "JOIN (SELECT v, row_number() OVER (ORDER BY v) AS at, count(*) OVER () AS n FROM (SELECT DISTINCT device AS v FROM frame)) d "
    "ON d.v = f.device "
    "JOIN (SELECT v, row_number() OVER (ORDER BY v) AS at, count(*) OVER () AS n FROM (SELECT DISTINCT geo AS v FROM frame)) g "
    "ON g.v = f.geo")))
def q_sparse_frame(spark, sf):
    """U2 as one sparse vector per session: its length and the positions of its ones."""
    from liftlens.operators.causal.encode import sparse_frame, vector_ones
    wide = sparse_frame(M.frame(spark, sf))
    v = F.unwrap_udt("features")
    return wide.select("session_key", "treatment", "outcome", F.coalesce(v["size"], F.size(v["values"])).alias("n_columns"),
                       F.concat_ws(",", vector_ones().cast("array<string>")).alias("ones"))


@register("confounder_cells", O.with_(*O.CELLED, body="SELECT * FROM cells"))
def q_confounder_cells(spark, sf):
    return M.cells(spark, sf)


@register("naive_difference", O.with_(*O.CELLED, body=(
    "SELECT round(CAST(sum(y1) AS DOUBLE) / sum(n1) - CAST(sum(y) - sum(y1) AS DOUBLE) / (sum(n) - sum(n1)), 9) "
    "AS ate FROM cells")))
def q_naive_difference(spark, sf):
    from liftlens.operators.causal.estimators import naive_difference
    return _r9(naive_difference(M.cells(spark, sf)), "ate")


@register("ipw_ate_saturated", O.with_(*O.SCORED_CHAIN, body=O.ipw_sql()))
def q_ipw_ate_saturated(spark, sf):
    from liftlens.operators.causal.estimators import ipw_ate
    return _r9(ipw_ate(M.scored(spark, sf)), "ate")


@register("ipw_ate_row_level", O.with_(*O.SCORED_CHAIN, body=(
    "SELECT round(sum(treatment * outcome / p) / sum(treatment / p) - "
    "sum((1 - treatment) * outcome / (1 - p)) / sum((1 - treatment) / (1 - p)), 9) AS ate "
    "FROM (SELECT f.treatment, f.outcome, least(greatest(s.ps, CAST(0.001 AS DOUBLE)), CAST(0.999 AS DOUBLE)) AS p "
    "FROM frame f JOIN scored s USING (is_new_user, device, geo))")))
def q_ipw_ate_row_level(spark, sf):
    from liftlens.operators.causal.cells import build_cells
    from liftlens.operators.causal.encode import CONFOUNDERS
    from liftlens.operators.causal.estimators import row_level_ipw
    from liftlens.operators.causal.propensity import saturated_scores
    fr = M.frame(spark, sf)
    return _r9(row_level_ipw(fr, saturated_scores(build_cells(fr)), CONFOUNDERS), "ate")


@register("matching_ate_mean", O.with_(*O.SCORED_CHAIN, body=_sub(O.matching_sql())))
def q_matching_ate_mean(spark, sf):
    from liftlens.operators.causal.estimators import matching_ate
    return _r9(matching_ate(M.scored(spark, sf)), "ate", "att", "atc")


@register("stratified_ate", O.with_(*O.SCORED_CHAIN, body=_sub(O.stratified_sql(candidates=(12,)))))
def q_stratified_ate(spark, sf):
    from liftlens.operators.causal.estimators import stratified_ate
    return _r9(stratified_ate(M.scored(spark, sf), num_strata=12), "ate")


@register("stratified_ate_auto", O.with_(*O.SCORED_CHAIN, body=_sub(
    O.stratified_sql(candidates=(50, 25, 12, 6, 3, 1), auto=True))))
def q_stratified_ate_auto(spark, sf):
    from liftlens.operators.causal.estimators import stratified_ate
    return _r9(stratified_ate(M.scored(spark, sf), num_strata="auto"), "ate")


SUMMARY_SQL = (
    "SELECT min(ps) AS ps_min, max(ps) AS ps_max, count(DISTINCT ps) AS n_distinct_scores, count(*) AS n_cells, "
    "CAST(sum(CASE WHEN ps < 0.05 THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS share_below_floor, "
    "CAST(sum(n1) AS DOUBLE) / sum(n) AS treated_share, count(*) FILTER (WHERE n1 = 0) AS cells_without_treated "
    "FROM scored")


@register("propensity_summary", O.with_(*O.SCORED_CHAIN, body=SUMMARY_SQL))
def q_propensity_summary(spark, sf):
    from liftlens.operators.causal.propensity import propensity_summary
    return propensity_summary(M.scored(spark, sf))


CLIP_GRID = ((0.001, 0.999), (0.01, 0.99), (0.05, 0.95), (0.1, 0.9), (0.5, 0.5))


@register("clip_sensitivity", O.with_(*O.SCORED_CHAIN, body=" UNION ALL ".join(
    f"SELECT CAST({lo} AS DOUBLE) AS clip_lo, CAST({hi} AS DOUBLE) AS clip_hi, * FROM ({O.ipw_sql(lo=str(lo), hi=str(hi))})"
    for lo, hi in CLIP_GRID)))
def q_clip_sensitivity(spark, sf):
    from liftlens.operators.causal.estimators import clip_sensitivity
    return _r9(clip_sensitivity(M.scored(spark, sf), CLIP_GRID), "ate")


@register("ipw_ate_logit", O.with_(*O.LOGIT_CHAIN, body=O.rounded_sql(O.ipw_sql(), "ate")))
def q_ipw_ate_logit(spark, sf):
    from liftlens.operators.causal.estimators import ipw_ate
    return _r6(ipw_ate(M.scored(spark, sf, model="logit")), "ate")


@register("matching_ate_logit", O.with_(*O.LOGIT_CHAIN, body=O.rounded_sql(O.matching_sql(), "ate", "att", "atc")))
def q_matching_ate_logit(spark, sf):
    from liftlens.operators.causal.estimators import matching_ate
    return _r6(matching_ate(M.scored(spark, sf, model="logit")), "ate", "att", "atc")


@register("stratified_ate_logit", O.with_(*O.LOGIT_CHAIN, body=O.rounded_sql(
    O.stratified_sql(candidates=(50, 25, 12, 6, 3, 1), auto=True), "ate")))
def q_stratified_ate_logit(spark, sf):
    from liftlens.operators.causal.estimators import stratified_ate
    return _r6(stratified_ate(M.scored(spark, sf, model="logit"), num_strata="auto"), "ate")


@register("propensity_summary_logit", O.with_(*O.LOGIT_CHAIN, body=O.rounded_sql(SUMMARY_SQL, "ps_min", "ps_max")))
def q_propensity_summary_logit(spark, sf):
    from liftlens.operators.causal.propensity import propensity_summary
    return _r6(propensity_summary(M.scored(spark, sf, model="logit")), "ps_min", "ps_max")


# --- estimates table and report views (C13 W1 F9-F11 U1 A12 R1-R4) ----------

@register("estimates_history", O.with_(*O.history_chain(), body="SELECT * FROM history"))
def q_estimates_history(spark, sf):
    return M.history(spark, sf)


@register("estimates_latest", O.with_(*O.latest_chain(), body="SELECT * FROM latest"))
def q_estimates_latest(spark, sf):
    """W1 over the rows of all daily runs."""
    return M.latest(spark, sf, last_only=False)


@register("causal_summary", O.with_(*O.summary_chain(), body="SELECT * FROM summary"))
def q_causal_summary(spark, sf):
    return M.summary(spark, sf)


@register("scorecards", O.with_(*O.summary_chain(), body=(
    "SELECT max(CASE WHEN estimate = 'naive_correlation' THEN conversion_lift END) AS naive_lift, "
    "max(CASE WHEN estimate = 'propensity_score_weighting' THEN conversion_lift END) AS causal_lift, "
    "max(CASE WHEN estimate = 'propensity_score_weighting' THEN n_sessions END) AS n_sessions FROM summary")))
def q_scorecards(spark, sf):
    from liftlens.operators.reports import scorecards
    return scorecards(M.summary(spark, sf))


@register("estimator_comparison", O.with_(*O.summary_chain(), body=(
    "SELECT estimate, conversion_lift * 100 AS lift_pp, estimate_kind, is_outlier, method_caveat FROM summary")))
def q_estimator_comparison(spark, sf):
    from liftlens.operators.reports import estimator_comparison
    return estimator_comparison(M.summary(spark, sf))


@register("causal_estimates", O.rounded_sql(O.single_run_sql(O.LOGIT_CHAIN), "ate", "naive_difference"))
def q_causal_estimates(spark, sf):
    """One run of the causal step with the logit score (the reference's model)."""
    from liftlens.operators.causal.results import ALL_METHODS, causal_estimates
    fr = M.frame(spark, sf)
    run_at = F.timestamp_add("DAY", F.lit(1), F.col("data_end").cast("timestamp_ntz"))
    return _r6(causal_estimates(fr, run_at, methods=ALL_METHODS, model="logit"), "ate", "naive_difference")


# --- quality (Q1-Q4) ---------------------------------------------------------

def _quality_models(spark, sf, before_write=lambda df, model: df):
    from liftlens.operators.metrics import spine_from
    from liftlens.operators.reports import causal_summary, channel_performance
    from liftlens.operators.sessions import sessionize
    from liftlens.session import materialize
    # staging and the mart are read by several tests and models: each is written once, events are read once
    stg = materialize(before_write(M.staging(spark, sf), "stg_ga4__events"), "staging")
    sessions = materialize(before_write(sessionize(stg), "fct_sessions"), "sessions")
    latest = M.latest(spark, sf, stg=stg)
    return {"stg_ga4__events": stg, "fct_sessions": sessions,
            "fct_causal_estimates": latest, "rpt_channel_performance": channel_performance(sessions),
            "rpt_causal_summary": causal_summary(latest),
            "metricflow_time_spine": spine_from(stg, "event_date")}


@register("quality_report", O.with_(*O.quality_chain(), body=O.quality_sql()))
def q_quality_report(spark, sf):
    from liftlens.operators.quality import run_tests
    return run_tests(_quality_models(spark, sf))


@register("quality_report_from_footers", ORACLE["quality_report"])
def q_quality_report_from_footers(spark, sf):
    """Q1-Q3 where the footers of the written staging and mart answer their not_null tests."""
    from liftlens.operators.quality import not_null_columns, run_tests
    from liftlens.sources.statistics import table_statistics
    models = _quality_models(spark, sf)
    written = {m: table_statistics(spark, models[m].inputFiles(), models[m].schema, nulls=not_null_columns(m))
               for m in ("stg_ga4__events", "fct_sessions")}
    return run_tests(models, statistics=written)


@register("quality_report_watched", ORACLE["quality_report"])
def q_quality_report_watched(spark, sf):
    """Q1-Q3 where the row-wise tests of staging and mart ride on the jobs that write them."""
    from liftlens.operators.quality import run_watched_tests, watch
    seen = {}

    def watched(df, model):
        df, seen[model] = watch(df, model)
        return df
    return run_watched_tests(_quality_models(spark, sf, watched), seen)


@register("quality_relationships", O.with_(*O.SESS, body=(
    "SELECT 'fct_sessions' AS child, 'session_key' AS child_column, 'stg_ga4__events' AS parent, "
    "'session_key' AS parent_column, (SELECT count(*) FROM (SELECT DISTINCT session_key FROM sessions "
    "WHERE session_key IS NOT NULL) c WHERE NOT EXISTS (SELECT 1 FROM stg p WHERE p.session_key = c.session_key)) "
    "AS failures UNION ALL "
    "SELECT 'stg_ga4__events', 'session_key', 'fct_sessions', 'session_key', (SELECT count(*) FROM "
    "(SELECT DISTINCT session_key FROM stg WHERE session_key IS NOT NULL) c WHERE NOT EXISTS "
    "(SELECT 1 FROM sessions p WHERE p.session_key = c.session_key))")))
def q_quality_relationships(spark, sf):
    from liftlens.operators.quality import relationships
    stg, ses = M.staging(spark, sf), M.sessions(spark, sf)
    return relationships(ses, "session_key", stg, "session_key", "fct_sessions", "stg_ga4__events").unionByName(
        relationships(stg, "session_key", ses, "session_key", "stg_ga4__events", "fct_sessions"))


def _bucketed(spark, sf, buckets=8):
    """Staging and the mart built from it, both bucketed by the session key."""
    from liftlens.operators.sessions import sessionize
    from liftlens.sources.bucketed import write_bucketed
    stg = write_bucketed(M.staging(spark, sf), "staging", buckets)
    return stg, write_bucketed(sessionize(stg), "sessions", buckets)


@register("sessions_bucketed", SESSION_SQL)
def q_sessions_bucketed(spark, sf):
    """A1 over staging bucketed by the session key: no exchange."""
    from liftlens.operators.sessions import sessionize
    from liftlens.sources.bucketed import write_bucketed
    return sessionize(write_bucketed(M.staging(spark, sf), "staging", 8))


@register("relationships_bucketed", ORACLE["quality_relationships"])
def q_relationships_bucketed(spark, sf):
    """Q4 between bucketed tables: both directions without an exchange on the key."""
    from liftlens.operators.quality import relationships
    stg, ses = _bucketed(spark, sf)
    return relationships(ses, "session_key", stg, "session_key", "fct_sessions", "stg_ga4__events").unionByName(
        relationships(stg, "session_key", ses, "session_key", "stg_ga4__events", "fct_sessions"))


# --- time spine and governed metrics (M1-M9) ---------------------------------

@register("time_spine", O.with_(*O.BASE, O.SPINE, body="SELECT date_day FROM spine"))
def q_time_spine(spark, sf):
    from liftlens.operators.metrics import spine_from
    return spine_from(M.staging(spark, sf), "event_date")


@register("time_spine_from_footers", ORACLE["time_spine"])
def q_time_spine_from_footers(spark, sf):
    """M8: the spine over the dates of the loaded staging table, from its footers."""
    from liftlens.operators.metrics import spine_from_statistics
    from liftlens.schema import STAGING
    from liftlens.sources.shards import load_staging
    from liftlens.sources.statistics import partition_files, table_statistics
    root, raw_root = _land_all(spark, sf)
    load_staging(spark, raw_root, f"{root}/stg")
    files = partition_files(spark, f"{root}/stg", "event_date_key")
    return spine_from_statistics(table_statistics(spark, files, STAGING, ranges=("event_date",)), "event_date")


def _metric_tables(spark, sf, estimates: bool = False):
    t = {"sessions": M.sessions(spark, sf)}
    if estimates:
        t["causal_estimates"] = M.latest(spark, sf)
    return t


def _metric(spark, sf, metrics, group_by, estimates=False, **kw):
    from liftlens.operators.metrics import query_metrics
    return query_metrics(_metric_tables(spark, sf, estimates), metrics, group_by, **kw)


@register("metric_sessions_by_day", O.with_(*O.SESS, body=(
    "SELECT session_date AS metric_time__day, count(session_key) AS sessions FROM sessions GROUP BY 1")))
def q_metric_sessions_by_day(spark, sf):
    return _metric(spark, sf, ["sessions"], ["metric_time__day"])


@register("metric_conversion_rate_by_day", O.with_(*O.SESS, body=(
    "SELECT session_date AS metric_time__day, CAST(sum(CAST(converted AS BIGINT)) AS DOUBLE) / "
    "count(session_key) AS conversion_rate FROM sessions GROUP BY 1")))
def q_metric_conversion_rate_by_day(spark, sf):
    return _metric(spark, sf, ["conversion_rate"], ["metric_time__day"])


@register("metric_conversion_rate_by_device", O.with_(*O.SESS, body=(
    "SELECT device_category AS session__device_category, count(session_key) AS sessions, "
    "CAST(sum(CAST(converted AS BIGINT)) AS BIGINT) AS conversions, "
    "CAST(sum(CAST(converted AS BIGINT)) AS DOUBLE) / count(session_key) AS conversion_rate "
    "FROM sessions GROUP BY 1")))
def q_metric_conversion_rate_by_device(spark, sf):
    return _metric(spark, sf, ["sessions", "conversions", "conversion_rate"], ["session__device_category"])


@register("metric_revenue_by_medium", O.with_(*O.SESS, body=(
    "SELECT first_touch_medium AS session__first_touch_medium, is_paid AS session__is_paid, "
    "CAST(sum(CAST(session_revenue_usd AS DECIMAL(38,12))) AS DOUBLE) AS revenue FROM sessions GROUP BY 1, 2")))
def q_metric_revenue_by_medium(spark, sf):
    return _metric(spark, sf, ["revenue"], ["session__first_touch_medium", "session__is_paid"])


LIFT = ("SELECT CAST(run_date AS DATE) AS metric_time__day, "
        "avg(CASE WHEN method = 'propensity_score_weighting' THEN {col} END) AS {name} FROM latest GROUP BY 1")


@register("metric_causal_lift", O.with_(*O.latest_chain(), body=LIFT.format(col="ate", name="causal_lift_estimate")))
def q_metric_causal_lift(spark, sf):
    from liftlens.operators.metrics import query_metrics
    return query_metrics({"causal_estimates": M.latest(spark, sf)}, ["causal_lift_estimate"], ["metric_time__day"])


@register("metric_naive_lift", O.with_(*O.latest_chain(), body=LIFT.format(col="naive_difference",
                                                                           name="naive_conversion_lift")))
def q_metric_naive_lift(spark, sf):
    from liftlens.operators.metrics import query_metrics
    return query_metrics({"causal_estimates": M.latest(spark, sf)}, ["naive_conversion_lift"], ["metric_time__day"])


@register("metric_mixed_models", O.with_(*O.latest_chain(), body=(
    "SELECT coalesce(a.d, b.d) AS metric_time__day, a.sessions, b.causal_lift_estimate FROM "
    "(SELECT session_date AS d, count(session_key) AS sessions FROM sessions GROUP BY 1) a FULL OUTER JOIN "
    f"({LIFT.format(col='ate', name='causal_lift_estimate').replace('AS metric_time__day', 'AS d')}) b "
    "ON a.d = b.d")))
def q_metric_mixed_models(spark, sf):
    return _metric(spark, sf, ["sessions", "causal_lift_estimate"], ["metric_time__day"], estimates=True)


@register("metric_sessions_spine", O.with_(*O.SESS, O.SPINE, body=(
    "SELECT s.date_day AS metric_time__day, coalesce(m.sessions, 0) AS sessions, "
    "coalesce(m.conversions, 0) AS conversions FROM spine s LEFT JOIN "
    "(SELECT session_date AS d, count(session_key) AS sessions, CAST(sum(CAST(converted AS BIGINT)) AS BIGINT) "
    "AS conversions FROM sessions GROUP BY 1) m ON s.date_day = m.d")))
def q_metric_sessions_spine(spark, sf):
    return _with_spine(spark, sf, ["sessions", "conversions"], "metric_time__day")


def _with_spine(spark, sf, metrics, time):
    """Metrics on a spine over the event dates; events are read once, staging is written for both."""
    from liftlens.operators.metrics import query_metrics, spine_from
    from liftlens.operators.sessions import sessionize
    from liftlens.session import materialize
    stg = materialize(M.staging(spark, sf), "staging")
    return query_metrics({"sessions": sessionize(stg)}, metrics, [time], spine=spine_from(stg, "event_date"),
                         fill_nulls_with=0)


# --- exploration (E1-E4, A13-A15, K4) ----------------------------------------

@register("table_shape", O.with_(*O.SESS, body=(
    "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, min(session_date) AS date_start, "
    "max(session_date) AS date_end FROM sessions")))
def q_table_shape(spark, sf):
    from liftlens.operators.reports import table_shape
    return table_shape(M.sessions(spark, sf))


@register("null_profile", O.with_(*O.SESS, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM sessions"
    for c in ("is_paid", "converted", "device_category", "geo_country", "is_new_user", "session_date"))))
def q_null_profile(spark, sf):
    from liftlens.operators.reports import null_profile
    return null_profile(M.sessions(spark, sf))


def _mart_statistics(spark, sf, **kw):
    from liftlens.session import materialize
    from liftlens.sources.statistics import table_statistics
    mart = materialize(M.sessions(spark, sf), "sessions")
    return table_statistics(spark, mart.inputFiles(), mart.schema, **kw)


@register("table_shape_from_footers", ORACLE["table_shape"])
def q_table_shape_from_footers(spark, sf):
    """E1 of the written mart: rows and dates from its footers."""
    from liftlens.operators.reports import table_shape_from_statistics
    return table_shape_from_statistics(_mart_statistics(spark, sf, ranges=("session_date",)))


@register("null_profile_from_footers", ORACLE["null_profile"])
def q_null_profile_from_footers(spark, sf):
    """E2 of the written mart: NULLs per column from its footers."""
    from liftlens.operators.reports import MODEL_COLUMNS, null_profile_from_statistics
    return null_profile_from_statistics(_mart_statistics(spark, sf, nulls=MODEL_COLUMNS))


@register("treatment_distribution", O.with_(*O.SESS, body=(
    "SELECT count(*) AS n_sessions, CAST(count_if(NOT is_paid) AS BIGINT) AS n_control, "
    "CAST(count_if(is_paid) AS BIGINT) AS n_paid, CAST(count_if(is_paid) AS DOUBLE) / count(*) AS share_paid, "
    "CAST(count_if(NOT is_paid) AS DOUBLE) / count_if(is_paid) AS imbalance_ratio, "
    "CAST(count_if(converted) AS BIGINT) AS n_converted, "
    "CAST(count_if(converted) AS DOUBLE) / count(*) AS share_converted FROM sessions")))
def q_treatment_distribution(spark, sf):
    from liftlens.operators.reports import treatment_distribution
    return treatment_distribution(M.sessions(spark, sf))


@register("arm_rates", O.with_(*O.FRAMED, body=(
    "SELECT treatment, count(*) AS sessions, CAST(sum(outcome) AS BIGINT) AS conversions, "
    "avg(outcome) AS conversion_rate FROM frame GROUP BY 1")))
def q_arm_rates(spark, sf):
    from liftlens.operators.reports import arm_rates
    return arm_rates(M.frame(spark, sf))


@register("sessions_preview", O.with_(*O.FRAMED, body="SELECT * FROM frame ORDER BY session_key LIMIT 5"))
def q_sessions_preview(spark, sf):
    from liftlens.operators.reports import preview
    return preview(M.frame(spark, sf))


# --- bootstrap and placebo (C8 C9 A16) ---------------------------------------

@register("ipw_bootstrap_replicates", O.with_(*O.boot_chain(), body="SELECT * FROM reps"))
def q_ipw_bootstrap_replicates(spark, sf):
    from liftlens.operators.causal.bootstrap import replicate_estimates
    return _r9(replicate_estimates(M.frame(spark, sf), method="rows"), "ate")


@register("ipw_bootstrap_ci", O.with_(*O.boot_chain(), O.CELLS, O.SCORED, body=O.bootstrap_ci_sql()))
def q_ipw_bootstrap_ci(spark, sf):
    from liftlens.operators.causal.bootstrap import bootstrap_ci, replicate_estimates
    fr = M.frame(spark, sf)
    reps = _r9(replicate_estimates(fr, method="rows"), "ate")
    point = _r9(_point(fr), "ate")
    return _r9(bootstrap_ci(reps, point), "ci_low", "ci_high", "sd")


def _point(fr):
    """Full-data IPW estimate from the same frame the replicates use."""
    from liftlens.operators.causal.cells import build_cells
    return _cell_point(build_cells(fr))


def _cell_point(cells, model="saturated"):
    from liftlens.operators.causal.estimators import ipw_ate
    from liftlens.operators.causal.propensity import score_cells
    return ipw_ate(score_cells(cells, model=model))


@register("bootstrap_logit")
def q_bootstrap_logit(spark, sf):
    """The reference's setting: logit score refitted in each of 200 replicates
    (grouped Poisson draws, cost independent of the number of sessions)."""
    from liftlens.operators.causal.bootstrap import bootstrap_ci, grouped_replicates
    cells = M.cells(spark, sf)
    return bootstrap_ci(grouped_replicates(cells, model="logit"), _cell_point(cells, "logit"))


@register("bootstrap_grouped_ci")
def q_bootstrap_grouped_ci(spark, sf):
    """Poisson bootstrap drawn per (cell, treatment, outcome): cost independent of sessions."""
    from liftlens.operators.causal.bootstrap import bootstrap_ci, grouped_replicates
    cells = M.cells(spark, sf)
    return bootstrap_ci(grouped_replicates(cells), _cell_point(cells))


@register("placebo_replicates", O.with_(*O.placebo_chain(), body=O.ipw_sql("pscored", keys="sim")))
def q_placebo_replicates(spark, sf):
    from liftlens.operators.causal.refute import placebo_estimates
    return _r9(placebo_estimates(M.frame(spark, sf)), "ate")


@register("placebo_effect", O.with_(*O.placebo_chain(), body=(
    "SELECT round(avg(ate), 9) AS placebo_effect, round(stddev_samp(ate), 9) AS placebo_sd, "
    f"count(*) AS simulations FROM ({O.ipw_sql('pscored', keys='sim')})")))
def q_placebo_effect(spark, sf):
    from liftlens.operators.causal.refute import placebo_effect, placebo_estimates
    return _r9(placebo_effect(_r9(placebo_estimates(M.frame(spark, sf)), "ate")), "placebo_effect", "placebo_sd")


@register("placebo_effect_logit", O.with_(*O.placebo_logit_chain(), body=(
    "SELECT round(avg(ate), 6) AS placebo_effect, round(stddev_samp(ate), 6) AS placebo_sd, "
    f"count(*) AS simulations FROM ({O.ipw_sql('pscored', keys='sim')})")))
def q_placebo_effect_logit(spark, sf):
    from liftlens.operators.causal.refute import placebo_effect, placebo_estimates
    return _r6(placebo_effect(_r9(placebo_estimates(M.frame(spark, sf), model="logit"), "ate")), "placebo_effect", "placebo_sd")


# --- incremental loads and streaming (S3 S5 S7 S12 S13 X1) -------------------

def _land_all(spark, sf):
    from liftlens.session import fresh_dir
    from liftlens.sources.shards import land_shards
    root = fresh_dir(spark, "shards")
    raw_root = f"{root}/raw"
    # testdata days are small: one file each
    land_shards(M.raw_events(spark, sf), raw_root, files_per_day=1)
    return root, raw_root


def _days(spark, raw_root):
    from liftlens.sources.shards import read_shards, shard_row_counts
    # one row per landed day: bounded by the calendar, not by the data
    return sorted(r["shard"] for r in shard_row_counts(read_shards(spark, raw_root)).select("shard").collect())


@register("incremental_reload", O.stg_query())
def q_incremental_reload(spark, sf):
    """Land shards, backfill part of the range, re-load an overlapping range and
    re-run one day (idempotent), then read staging back."""
    from liftlens.sources.shards import backfill, land_shards, load_staging, read_staging
    root, raw_root = _land_all(spark, sf)
    stg_root = f"{root}/stg"
    days = _days(spark, raw_root)
    half = len(days) // 2
    backfill(spark, raw_root, stg_root, days[: half + 3])                # S13, one job
    load_staging(spark, raw_root, stg_root, days=days[half:])            # S5: overlap replaced
    land_shards(M.raw_events(spark, sf), raw_root, days=days[:1], files_per_day=1)   # S3: re-land one day
    load_staging(spark, raw_root, stg_root, days=days[:1])               # idempotent re-run
    return read_staging(spark, stg_root)


@register("full_refresh_one_day", O.with_(*O.BASE, body=(
    f"SELECT {O.STG_COLS} FROM stg WHERE event_date_key = (SELECT max(event_date_key) FROM stg)")))
def q_full_refresh_one_day(spark, sf):
    """A static overwrite replaces the whole staging table, here with the last day only."""
    from liftlens.sources.shards import load_staging, read_staging
    root, raw_root = _land_all(spark, sf)
    stg_root = f"{root}/stg"
    days = _days(spark, raw_root)
    load_staging(spark, raw_root, stg_root)                              # all days
    load_staging(spark, raw_root, stg_root, days=days[-1:], full_refresh=True)
    return read_staging(spark, stg_root)


@register("stream_sessions_equals_batch", SESSION_SQL)
def q_stream_sessions_equals_batch(spark, sf):
    """Shards streamed in several micro-batches into staging, then sessionized."""
    from liftlens.operators.sessions import sessionize
    from liftlens.sources.shards import read_staging
    from liftlens.streaming.shard_stream import stream_shards_to_staging
    from liftlens.session import fresh_dir
    from liftlens.sources.shards import land_shards
    root, raw = fresh_dir(spark, "shards"), M.raw_events(spark, sf)
    raw_root, stg_root = f"{root}/raw", f"{root}/stg"
    # sessions cross midnight, so days of one session arrive in different micro-batches
    for parity in (0, 1):
        land_shards(raw.where(F.col("event_date").cast("int") % 2 == parity), raw_root, files_per_day=1)
    stream_shards_to_staging(spark, raw_root, stg_root, f"{root}/stream-checkpoint", max_files_per_trigger=1)
    return sessionize(read_staging(spark, stg_root))


@register("stream_sessions_stateful", SESSION_SQL)
def q_stream_sessions_stateful(spark, sf):
    """X1 + X2: sessions from the state of an event stream, stopped and started again, its parts folded between."""
    from liftlens.session import fresh_dir
    from liftlens.streaming.session_stream import compact, read_event_files, read_sessions, stream_sessions
    root, raw = fresh_dir(spark, "sessions"), M.raw_events(spark, sf)
    # arrivals in order of events, not of days: one session's events come in several micro-batches
    for run in (0, 1):
        some = raw.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == run)
        some.repartition(2, "event_id").write.mode("append").parquet(f"{root}/arrived")
        stream_sessions(read_event_files(spark, f"{root}/arrived", 1), f"{root}/partials", f"{root}/state")
        if run == 0:
            compact(spark, f"{root}/partials")
    return read_sessions(spark, f"{root}/partials")


# --- the same estimators on the order star schema ----------------------------

@register("orders_urgency_cells", O.with_(*O.ORDER_CHAIN, body="SELECT * FROM ocells"))
def q_orders_urgency_cells(spark, sf):
    return M.order_cells(spark, sf)


@register("orders_urgency_naive", O.with_(*O.ORDER_CHAIN, body=(
    "SELECT round(CAST(sum(y1) AS DOUBLE) / sum(n1) - CAST(sum(y) - sum(y1) AS DOUBLE) / (sum(n) - sum(n1)), 9) "
    "AS ate FROM ocells")))
def q_orders_urgency_naive(spark, sf):
    from liftlens.operators.causal.estimators import naive_difference
    return _r9(naive_difference(M.order_cells(spark, sf)), "ate")


@register("orders_urgency_ipw", O.with_(*O.ORDER_CHAIN, body=O.ipw_sql("oscored")))
def q_orders_urgency_ipw(spark, sf):
    from liftlens.operators.causal.estimators import ipw_ate
    from liftlens.operators.causal.propensity import saturated_scores
    return _r9(ipw_ate(saturated_scores(M.order_cells(spark, sf))), "ate")


@register("orders_urgency_matching", O.with_(*O.ORDER_CHAIN, body=_sub(O.matching_sql("oscored"))))
def q_orders_urgency_matching(spark, sf):
    from liftlens.operators.causal.estimators import matching_ate
    from liftlens.operators.causal.propensity import saturated_scores
    return _r9(matching_ate(saturated_scores(M.order_cells(spark, sf))), "ate", "att", "atc")


@register("orders_urgency_stratified", O.with_(*O.ORDER_CHAIN, body=_sub(
    O.stratified_sql("oscored", candidates=(50, 25, 12, 6, 3, 1), auto=True))))
def q_orders_urgency_stratified(spark, sf):
    from liftlens.operators.causal.estimators import stratified_ate
    from liftlens.operators.causal.propensity import saturated_scores
    return _r9(stratified_ate(saturated_scores(M.order_cells(spark, sf))), "ate")


@register("orders_urgency_logit", O.with_(*O.ORDER_LOGIT_CHAIN, body=O.rounded_sql(O.ipw_sql("oscored"), "ate")))
def q_orders_urgency_logit(spark, sf):
    from liftlens.operators.causal.star import ORDER_CONFOUNDERS
    from liftlens.operators.causal.estimators import ipw_ate
    from liftlens.operators.causal.propensity import logit_scores
    return _r6(ipw_ate(logit_scores(M.order_cells(spark, sf), ORDER_CONFOUNDERS)), "ate")


@register("placebo_effect_grouped")
def q_placebo_effect_grouped(spark, sf):
    """Placebo permutations drawn per cell (exact permutation distribution, cost independent of sessions)."""
    from liftlens.operators.causal.refute import grouped_placebo, placebo_effect
    return placebo_effect(grouped_placebo(M.cells(spark, sf)))


@register("window_sensitivity", O.window_sensitivity_sql())
def q_window_sensitivity(spark, sf):
    """Each estimator on each calendar week of sessions."""
    from liftlens.operators.causal.encode import encoded_cells
    from liftlens.operators.causal.results import sensitivity_from_window_cells
    weekly = M.sessions(spark, sf).withColumn("window_start", F.trunc("session_date", "week"))
    return M.rounded(sensitivity_from_window_cells(
        encoded_cells(weekly, keys=["window_start"], null_treatment=M.NULL_TREATMENT)))


@register("causal_estimates_saturated", O.single_run_sql())
def q_causal_estimates_saturated(spark, sf):
    """C13 for one run with the saturated score: the estimate rows the causal step writes."""
    from liftlens.operators.causal.results import ALL_METHODS, causal_estimates
    fr = M.frame(spark, sf)
    run_at = F.timestamp_add("DAY", F.lit(1), F.col("data_end").cast("timestamp_ntz"))
    return M.rounded(causal_estimates(fr, run_at, methods=ALL_METHODS, model="saturated"))


@register("matching_ate_seeded", O.with_(*O.SCORED_CHAIN, body=_sub(O.matching_sql(seed=42))))
def q_matching_ate_seeded(spark, sf):
    """C6 with the seeded tie policy: one arbitrary unit per tied score group (instability on show)."""
    from liftlens.operators.causal.estimators import matching_ate
    return _r9(matching_ate(M.scored(spark, sf), tie_policy="seeded", seed=42), "ate", "att", "atc")


@register("window_clip_sensitivity", O.window_clip_sql(CLIP_GRID))
def q_window_clip_sensitivity(spark, sf):
    """Each estimator on each calendar week with each clip of the score."""
    from liftlens.operators.causal.encode import encoded_cells
    from liftlens.operators.causal.results import window_clip_sensitivity
    weekly = M.sessions(spark, sf).withColumn("window_start", F.trunc("session_date", "week"))
    cells = encoded_cells(weekly, keys=["window_start"], null_treatment=M.NULL_TREATMENT)
    return _r9(window_clip_sensitivity(cells, CLIP_GRID), "ate")


# --- metric grain (M7) ---------------------------------------------------------

def _grain_sql(grain: str) -> str:
    return O.with_(*O.SESS, body=(
        f"SELECT CAST(date_trunc('{grain}', session_date) AS DATE) AS metric_time__{grain}, count(session_key) AS sessions, "
        "CAST(sum(CAST(converted AS BIGINT)) AS DOUBLE) / count(session_key) AS conversion_rate FROM sessions GROUP BY 1"))


@register("metric_sessions_by_week", _grain_sql("week"))
def q_metric_sessions_by_week(spark, sf):
    return _metric(spark, sf, ["sessions", "conversion_rate"], ["metric_time__week"])


@register("metric_sessions_by_month_spine", O.with_(*O.SESS, O.SPINE, body=(
    "SELECT s.m AS metric_time__month, coalesce(x.sessions, 0) AS sessions FROM "
    "(SELECT DISTINCT CAST(date_trunc('month', date_day) AS DATE) AS m FROM spine) s LEFT JOIN "
    "(SELECT CAST(date_trunc('month', session_date) AS DATE) AS m, count(session_key) AS sessions FROM sessions GROUP BY 1) x "
    "ON s.m = x.m")))
def q_metric_sessions_by_month_spine(spark, sf):
    return _with_spine(spark, sf, ["sessions"], "metric_time__month")


# --- nothing is dropped silently (A6 S3 S6 S7 F1), table writes (S8 S11), gates (Q5 M9) ------

@register("sessions_subcent_revenue", SESSION_SQL.replace("coalesce(purchase_revenue_usd, 0)",
                                                          "coalesce(purchase_revenue_usd / 1000, 0)"))
def q_sessions_subcent_revenue(spark, sf):
    """Amounts below a cent reach the session sum."""
    from liftlens.operators.sessions import sessionize
    stg = M.staging(spark, sf)
    return sessionize(stg.withColumn("purchase_revenue_usd", F.col("purchase_revenue_usd") / 1000))


@register("reload_emptied_day", O.with_(*O.BASE, body=(
    f"SELECT {O.STG_COLS} FROM stg WHERE event_date_key <> {ONE_SHARD}")))
def q_reload_emptied_day(spark, sf):
    """A day whose source has become empty is empty after it is landed and loaded again."""
    from liftlens.sources.shards import land_shards, load_staging, read_staging
    root, raw_root = _land_all(spark, sf)
    load_staging(spark, raw_root, f"{root}/stg")
    without = M.raw_events(spark, sf).where(F.col("event_date") != ONE_SHARD)
    land_shards(without, raw_root, days=[ONE_SHARD], files_per_day=1)
    load_staging(spark, raw_root, f"{root}/stg", days=[ONE_SHARD])
    return read_staging(spark, f"{root}/stg")


@register("load_with_rejects", O.with_(*O.BASE, body=(
    f"SELECT CASE WHEN event_date_key >= {DECLARED_RANGE[0]} AND event_date_key < {DECLARED_RANGE[1]} THEN 'staged' "
    "ELSE 'rejected' END AS outcome, event_date_key, count(*) AS n FROM stg GROUP BY ALL")))
def q_load_with_rejects(spark, sf):
    """Rows outside the declared range are written beside staging, none is lost."""
    from liftlens.sources.shards import load_staging, read_rejects, read_staging
    root, raw_root = _land_all(spark, sf)
    load_staging(spark, raw_root, f"{root}/stg", key_range=DECLARED_RANGE, rejects_root=f"{root}/rejects")
    both = read_staging(spark, f"{root}/stg").withColumn("outcome", F.lit("staged")).unionByName(
        read_rejects(spark, f"{root}/rejects").withColumn("outcome", F.lit("rejected")))
    return both.groupBy("outcome", "event_date_key").agg(F.count(F.lit(1)).alias("n"))


def _outcome(action) -> str:
    try:
        action()
    except Exception as e:  # the kind of failure is the result
        return type(e).__name__
    return "done"


@register("schema_drift_outcomes", O.with_(*O.BASE, body=(
    "SELECT 'added column' AS change, 'SchemaDriftError' AS outcome, CAST(0 AS BIGINT) AS staged UNION ALL "
    "SELECT 'missing column', 'SchemaDriftError', 0 UNION ALL SELECT 'one file of a day', 'SchemaDriftError', 0 UNION ALL "
    "SELECT 'none', 'done', (SELECT count(*) FROM stg)")))
def q_schema_drift_outcomes(spark, sf):
    """Shards of which any file differs from the declared columns stop the load before it writes."""
    from liftlens.session import fresh_dir
    from liftlens.sources.shards import load_staging, read_staging
    from liftlens.sources.versions import table_exists
    raw = M.raw_events(spark, sf).withColumn("shard", F.col("event_date"))
    cases = {"added column": (raw.withColumn("surprise", F.lit(1)), None), "missing column": (raw.drop("geo"), None),
             "one file of a day": (raw, raw.where(F.col("shard") == ONE_SHARD).drop("geo")), "none": (raw, None)}
    rows = []
    for change, (df, late) in cases.items():
        root = fresh_dir(spark, "drift")
        # plain folders of another writer; each day has its rows in several files
        df.repartition("shard", F.col("event_id") % (8 if late is not None else 1)).write.partitionBy("shard").parquet(f"{root}/raw")
        if late is not None:
            late.limit(1).write.mode("append").partitionBy("shard").parquet(f"{root}/raw")
        outcome = _outcome(lambda root=root: load_staging(spark, f"{root}/raw", f"{root}/stg"))
        staged = read_staging(spark, f"{root}/stg").count() if table_exists(spark, f"{root}/stg") else 0
        rows.append((change, outcome, staged))
    return spark.createDataFrame(rows, "change string, outcome string, staged long")


@register("reload_in_one_step", O.with_(*O.BASE, body=(
    "SELECT step, event_date_key, count(*) AS n FROM stg, (VALUES ('before', 1), ('written', 1), ('published', 2)) v(step, f) "
    f"WHERE f = 1 OR event_date_key <> {ONE_SHARD} GROUP BY ALL")))
def q_reload_in_one_step(spark, sf):
    """A reload of all days, one of them emptied, shows nothing until it is published, and then all of it."""
    from liftlens.session import fresh_dir
    from liftlens.sources.shards import read_staging
    from liftlens.sources.versions import publish, stage
    root, stg = f"{fresh_dir(spark, 'one-step')}/stg", M.staging(spark, sf)
    publish(spark, stage(stg, root, "event_date_key"))
    steps = [read_staging(spark, root).withColumn("step", F.lit("before"))]
    load = stage(stg.where(F.col("event_date_key") != int(ONE_SHARD)), root, "event_date_key")
    steps.append(read_staging(spark, root).withColumn("step", F.lit("written")))
    publish(spark, load, [ONE_SHARD])
    steps.append(read_staging(spark, root).withColumn("step", F.lit("published")))
    both = steps[0].unionByName(steps[1]).unionByName(steps[2])
    return both.groupBy("step", "event_date_key").agg(F.count(F.lit(1)).alias("n"))


@register("session_mart_rebuild", SESSION_SQL)
def q_session_mart_rebuild(spark, sf):
    """The mart is replaced as a whole, here over an older and larger table."""
    from liftlens.session import fresh_dir
    from liftlens.sources.shards import write_table
    path, sessions = fresh_dir(spark, "mart"), M.sessions(spark, sf)
    write_table(sessions.unionByName(sessions), path)
    write_table(sessions, path)
    return spark.read.parquet(path)


@register("estimate_sink", O.with_(*O.latest_chain(), body=(
    "SELECT method, round(ate, 9) AS ate, round(naive_difference, 9) AS naive_difference, n_sessions, run_at, "
    "mode, load_seq FROM latest, (VALUES ('append', CAST(1 AS BIGINT)), ('append', CAST(2 AS BIGINT)), "
    "('truncate', CAST(1 AS BIGINT))) v(mode, load_seq)")))
def q_estimate_sink(spark, sf):
    """One run written twice in either mode; append keeps both loads apart, truncate the last."""
    from liftlens.session import fresh_dir
    from liftlens.sources.sinks import read_estimates, write_estimates
    run = M.history(spark, sf, last_only=True)
    tables = []
    for mode in ("append", "truncate"):
        path = fresh_dir(spark, "estimates")
        write_estimates(run, path, mode)
        write_estimates(run, path, mode)
        tables.append(read_estimates(spark, path).withColumn("mode", F.lit(mode)))
    both = tables[0].unionByName(tables[1])
    return _r9(both.select("method", "ate", "naive_difference", "n_sessions", "run_at", "mode", "load_seq"),
               "ate", "naive_difference")


@register("gate_and_registry", O.with_(*O.SESS, body=(
    "SELECT 'gate' AS step, CASE WHEN count(*) FILTER (WHERE is_paid IS NULL) > 0 THEN 'QualityGateError' ELSE 'done' END "
    "AS outcome FROM sessions UNION ALL SELECT 'metrics', 'done' UNION ALL SELECT 'metrics without converted', 'KeyError'")))
def q_gate_and_registry(spark, sf):
    """Q5 and M9: the gate stops on a failing data test, the registry check on a missing column."""
    from liftlens.operators.metrics import validate
    from liftlens.operators.quality import DECLARED_TESTS, gate, run_tests
    sessions, names = M.sessions(spark, sf), ("sessions", "conversions", "conversion_rate", "revenue")
    tests = tuple(t for t in DECLARED_TESTS if (t.model, t.column, t.test) == ("fct_sessions", "is_paid", "not_null"))
    rows = [("gate", _outcome(lambda: gate(run_tests({"fct_sessions": sessions}, tests)))),
            ("metrics", _outcome(lambda: validate({"sessions": sessions}, names))),
            ("metrics without converted", _outcome(lambda: validate({"sessions": sessions.drop("converted")}, names)))]
    return spark.createDataFrame(rows, "step string, outcome string")
