"""DuckDB SQL for each registered query (the correctness oracle).

Each query is an independent SQL text over the pre-registered testdata views;
shared logic is written once as CTE text and composed.  These strings are the
specification the Spark plans are checked against, not an execution path.
"""

from __future__ import annotations

PAID_SQL = "('cpc', 'cpm', 'ppc', 'paid')"


def _param_sql(key: str, int_value: str) -> str:
    return ("{'key': '" + key + "', 'value': {'string_value': NULL::VARCHAR, 'int_value': "
            + f"CAST({int_value} AS BIGINT)" + ", 'float_value': NULL::DOUBLE, 'double_value': NULL::DOUBLE}}")


RAW_EVENTS = f"""
raw_events AS (
  SELECT e.event_id,
    strftime(e.ts, '%Y%m%d') AS event_date,
    e.us AS event_timestamp,
    CASE e.event_type WHEN 'signup' THEN 'first_visit' WHEN 'view' THEN 'page_view'
         WHEN 'error' THEN 'session_start' ELSE e.event_type END AS event_name,
    'u' || CAST(e.user_id AS VARCHAR) AS user_pseudo_id,
    CASE WHEN e.event_id % 37 = 0 THEN [{_param_sql('engagement_k', 'e.k')}]
         ELSE [{_param_sql('engagement_k', 'e.k')},
               {_param_sql('ga_session_id', '(e.us - 43200000000) // 86400000000')}] END AS event_params,
    {{'medium': CASE WHEN e.k < 3 * (e.user_id % 3) + 2 THEN 'cpc'
                    WHEN e.k < 3 * (e.user_id % 3) + 3 THEN 'cpm'
                    WHEN e.k < 35 THEN 'organic' WHEN e.k < 50 THEN 'referral'
                    WHEN e.k < 70 THEN '(none)' WHEN e.k < 80 THEN '<Other>'
                    WHEN e.k < 90 THEN 'email' END,
      'source': CASE e.k % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'newsletter' WHEN 2 THEN '(direct)' END,
      'name': CASE WHEN e.k % 6 < 5 THEN 'camp' || CAST(e.k % 6 AS VARCHAR) END}} AS traffic_source,
    {{'category': CASE WHEN e.user_id % 10 < 5 THEN 'desktop' WHEN e.user_id % 10 < 9 THEN 'mobile'
                      ELSE 'tablet' END}} AS device,
    {{'country': CASE WHEN (e.user_id // 7) % 16 <> 15 THEN 'C' || CAST((e.user_id // 7) % 16 AS VARCHAR) END}} AS geo,
    {{'purchase_revenue_in_usd': CASE WHEN e.event_type = 'purchase' THEN e.value END}} AS ecommerce
  FROM (SELECT *, epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events) e
)"""

TYPED_EVENTS = """
typed_events AS (
  SELECT CAST(r.event_date AS BIGINT) AS event_date_key,
    CAST(strptime(r.event_date, '%Y%m%d') AS DATE) AS event_date,
    make_timestamp(r.event_timestamp) AS event_at,
    r.event_name, r.user_pseudo_id,
    list_filter(r.event_params, lambda p: p.key = 'ga_session_id')[1].value.int_value AS ga_session_id,
    r.traffic_source.medium AS traffic_medium,
    r.traffic_source.source AS traffic_source,
    r.traffic_source.name AS traffic_campaign,
    r.device.category AS device_category,
    r.geo.country AS geo_country,
    r.ecommerce.purchase_revenue_in_usd AS purchase_revenue_usd,
    r.event_id
  FROM raw_events r
)"""

STG = """
stg AS (
  SELECT *, user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR) AS session_key
  FROM typed_events WHERE ga_session_id IS NOT NULL
)"""


def _first_touch(col: str) -> str:
    return f"arg_min({col}, (event_at, event_id)) FILTER (WHERE {col} IS NOT NULL)"


SESSIONS = f"""
sessions AS (
  SELECT session_key, user_pseudo_id,
    min(event_date_key) AS session_date_key,
    min(event_date) AS session_date,
    min(event_at) AS session_start_at,
    bool_or(traffic_medium IN {PAID_SQL}) AS is_paid,
    {_first_touch('traffic_medium')} AS first_touch_medium,
    {_first_touch('traffic_source')} AS first_touch_source,
    {_first_touch('traffic_campaign')} AS first_touch_campaign,
    bool_or(event_name = 'purchase') AS converted,
    CAST(sum(CAST(coalesce(purchase_revenue_usd, 0) AS DECIMAL(38,12))) AS DOUBLE) AS session_revenue_usd,
    min(device_category) AS device_category,
    min(geo_country) AS geo_country,
    bool_or(event_name = 'first_visit') AS is_new_user
  FROM stg GROUP BY session_key, user_pseudo_id
)"""

CHANNEL_CASE = f"""CASE WHEN first_touch_medium IN {PAID_SQL} THEN 'paid'
         WHEN first_touch_medium = 'organic' THEN 'organic'
         WHEN first_touch_medium = 'referral' THEN 'referral'
         WHEN first_touch_medium = '(none)' OR first_touch_medium IS NULL THEN 'direct'
         ELSE 'other' END"""

CHANNEL = f"""
channel AS (
  SELECT session_date,
    {CHANNEL_CASE} AS channel,
    first_touch_medium,
    count(*) AS sessions,
    CAST(count_if(converted) AS BIGINT) AS conversions,
    CAST(count_if(converted) AS DOUBLE) / count(*) AS conversion_rate,
    CAST(round(sum(CAST(session_revenue_usd AS DECIMAL(38,12))), 2) AS DOUBLE) AS revenue_usd
  FROM sessions GROUP BY ALL
)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


# one row per item of an event with a session; events without items have none here
ITEMS = """
items AS (
  SELECT s.event_id, s.event_date, s.event_name, s.session_key, s.user_pseudo_id,
    CAST(row_number() OVER (PARTITION BY s.event_id ORDER BY l.l_linenumber, CAST(l.l_partkey AS VARCHAR),
      l.l_extendedprice / l.l_quantity, CAST(l.l_quantity AS BIGINT), l.l_returnflag <> 'R', l.l_extendedprice) - 1 AS INTEGER)
      AS item_pos,
    CAST(l.l_partkey AS VARCHAR) AS item_id, CAST(NULL AS VARCHAR) AS item_name,
    l.l_extendedprice / l.l_quantity AS price_in_usd, CAST(l.l_quantity AS BIGINT) AS quantity,
    CASE WHEN l.l_returnflag <> 'R' THEN l.l_extendedprice
         ELSE l.l_extendedprice / l.l_quantity * CAST(l.l_quantity AS BIGINT) END AS item_revenue_usd
  FROM stg s JOIN lineitem l ON l.l_orderkey = s.event_id AND s.event_name = 'purchase'
)"""

BASE = (RAW_EVENTS, TYPED_EVENTS, STG)
SESS = BASE + (SESSIONS,)
CHAN = SESS + (CHANNEL,)

STG_COLS = ("event_date_key, event_date, event_at, event_name, user_pseudo_id, ga_session_id, "
            "traffic_medium, traffic_source, traffic_campaign, device_category, geo_country, "
            "purchase_revenue_usd, event_id, session_key")


def stg_query() -> str:
    return with_(*BASE, body=f"SELECT {STG_COLS} FROM stg")


# --- causal chain -----------------------------------------------------------

TOP = """
top AS (
  SELECT geo_country FROM sessions WHERE geo_country IS NOT NULL
  GROUP BY geo_country ORDER BY count(*) DESC, geo_country ASC LIMIT 10
)"""

FRAME = """
frame AS (
  SELECT s.session_key, s.session_date,
    CAST(coalesce(s.is_paid, false) AS INTEGER) AS treatment,
    CAST(s.converted AS INTEGER) AS outcome,
    CAST(s.is_new_user AS INTEGER) AS is_new_user,
    coalesce(s.device_category, 'unknown') AS device,
    CASE WHEN t.geo_country IS NOT NULL THEN s.geo_country ELSE 'other_country' END AS geo
  FROM sessions s LEFT JOIN top t ON s.geo_country = t.geo_country
)"""

CELLS = """
cells AS (
  SELECT is_new_user, device, geo, count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n1,
    CAST(sum(outcome) AS BIGINT) AS y, CAST(sum(treatment * outcome) AS BIGINT) AS y1
  FROM frame GROUP BY ALL
)"""

SCORED = """
scored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM cells)"""

FRAMED = SESS + (TOP, FRAME)
CELLED = FRAMED + (CELLS,)
SCORED_CHAIN = CELLED + (SCORED,)


def ipw_sql(src: str = "scored", lo: str = "0.001", hi: str = "0.999", keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    grp = f" GROUP BY {keys}" if keys else ""
    return (f"SELECT {k}round(sum(y1 / p) / sum(n1 / p) - sum((y - y1) / (1 - p)) / sum((n - n1) / (1 - p)), 9) AS ate "
            f"FROM (SELECT *, least(greatest(ps, CAST({lo} AS DOUBLE)), CAST({hi} AS DOUBLE)) AS p FROM {src}){grp}")


def matching_sql(src: str = "scored", keys: str = "", seed: int | None = None) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    grp = f" GROUP BY {keys}" if keys else ""
    before = f"OVER ({part}ORDER BY ps ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"OVER ({part}ORDER BY ps ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

    def nb(arm, cnt, tot):
        s = f"CASE WHEN {cnt} > 0 THEN ps END"
        mean = f"CAST({tot} AS DOUBLE) / {cnt}"
        if seed is not None:    # one picked unit per tied score group
            from liftlens.functions.hashing import sql_uniform
            u = sql_uniform(f"'match|{arm[0]}|' || CAST(rk AS VARCHAR) || '|{seed}'")
            mean = f"CAST({u} < {mean} AS DOUBLE)"
        m = f"CASE WHEN {cnt} > 0 THEN {mean} END"
        return (f"last_value({s} IGNORE NULLS) {before} AS {arm}_ps_prev, "
                f"last_value({m} IGNORE NULLS) {before} AS {arm}_m_prev, "
                f"first_value({s} IGNORE NULLS) {after} AS {arm}_ps_next, "
                f"first_value({m} IGNORE NULLS) {after} AS {arm}_m_next")

    def pick(arm):
        return (f"(CASE WHEN {arm}_ps_prev IS NULL THEN {arm}_m_next WHEN {arm}_ps_next IS NULL THEN {arm}_m_prev "
                f"WHEN ps - {arm}_ps_prev <= {arm}_ps_next - ps THEN {arm}_m_prev ELSE {arm}_m_next END)")
    return (
        f"WITH st AS (SELECT {k}ps, sum(n1) AS n1, sum(n - n1) AS n0, sum(y1) AS y1, sum(y - y1) AS y0 "
        f"FROM {src} GROUP BY {k}ps), "
        f"nb AS (SELECT *, {nb('c', 'n0', 'y0')}, {nb('t', 'n1', 'y1')} FROM "
        f"(SELECT *, row_number() OVER ({part}ORDER BY ps) AS rk FROM st)), "
        f"m AS (SELECT {k}n1, n0, CASE WHEN n1 > 0 THEN y1 - n1 * {pick('c')} END AS att_part, "
        f"CASE WHEN n0 > 0 THEN n0 * {pick('t')} - y0 END AS atc_part FROM nb) "
        f"SELECT {k}"
        f"CASE WHEN sum(n1) > 0 AND sum(n0) > 0 THEN round((sum(att_part) + sum(atc_part)) / (sum(n1) + sum(n0)), 9) END AS ate, "
        f"CASE WHEN sum(n1) > 0 AND sum(n0) > 0 THEN round(sum(att_part) / sum(n1), 9) END AS att, "
        f"CASE WHEN sum(n1) > 0 AND sum(n0) > 0 THEN round(sum(atc_part) / sum(n0), 9) END AS atc "
        f"FROM m{grp}")


def stratified_sql(src: str = "scored", candidates=(12,), auto: bool = False, min_per_arm: int = 10,
                   keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    cands = ", ".join(str(c) for c in candidates)
    kept = f"least(T, C) > {min_per_arm}"
    body = (
        f"WITH st AS (SELECT {k}ps, sum(n) AS n, sum(n1) AS n1, sum(y1) AS y1, sum(y - y1) AS y0 "
        f"FROM {src} GROUP BY {k}ps), "
        f"rk AS (SELECT *, coalesce(sum(n) OVER ({part}ORDER BY ps ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
        f" + (n + 1) / 2.0 AS rnk, sum(n) OVER ({part.strip()}) AS NN FROM st), "
        f"sx AS (SELECT rk.*, c.S, round_even(rnk / NN * c.S, 0) AS stratum FROM rk, "
        f"(SELECT unnest([{cands}]) AS S) c), "
        f"strata AS (SELECT {k}S, stratum, sum(n1) AS T, sum(n - n1) AS C, sum(y1) AS Y1, sum(y0) AS Y0 "
        f"FROM sx GROUP BY ALL), "
        f"per_s AS (SELECT {k}S, count(*) FILTER (WHERE {kept}) AS kept_strata, "
        f"sum(CASE WHEN {kept} THEN (Y1 / T - Y0 / C) * (T + C) END) / "
        f"sum(CASE WHEN {kept} THEN T + C END) AS ate FROM strata GROUP BY ALL) ")
    if not auto:
        return body + f"SELECT {k}round(ate, 9) AS ate, S AS num_strata, kept_strata FROM per_s"
    grp = f" GROUP BY {keys}" if keys else ""
    choose = ("coalesce(arg_max({'ate': ate, 'S': S, 'kept': kept_strata}, S) FILTER (WHERE kept_strata >= 0.5 * S), "
              "arg_min({'ate': ate, 'S': S, 'kept': kept_strata}, S))")
    return body + (f"SELECT {k}round(c.ate, 9) AS ate, c.S AS num_strata, c.kept AS kept_strata "
                   f"FROM (SELECT {k}{choose} AS c FROM per_s{grp})")


# --- estimate history and the report views over it -------------------------

# The run of day d: sessions, top countries and frame from the events dated <= d.
RUNS = """
runs AS (
  SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS run_date
  FROM (SELECT min(event_date) AS a, max(event_date) AS b FROM stg)
)"""

RSESSIONS = f"""
rsessions AS (
  SELECT r.run_date, session_key, user_pseudo_id, min(event_date) AS session_date,
    CAST(coalesce(bool_or(traffic_medium IN {PAID_SQL}), false) AS INTEGER) AS treatment,
    CAST(bool_or(event_name = 'purchase') AS INTEGER) AS outcome,
    CAST(bool_or(event_name = 'first_visit') AS INTEGER) AS is_new_user,
    coalesce(min(device_category), 'unknown') AS device, min(geo_country) AS geo_country
  FROM runs r JOIN stg e ON e.event_date <= r.run_date GROUP BY r.run_date, session_key, user_pseudo_id
)"""

RTOP = """
rtop AS (
  SELECT run_date, geo_country FROM (
    SELECT run_date, geo_country, row_number() OVER (PARTITION BY run_date ORDER BY count(*) DESC, geo_country) AS place
    FROM rsessions WHERE geo_country IS NOT NULL GROUP BY run_date, geo_country) WHERE place <= 10
)"""

RFRAME = """
rframe AS (
  SELECT s.*, CASE WHEN t.geo_country IS NOT NULL THEN s.geo_country ELSE 'other_country' END AS geo
  FROM rsessions s LEFT JOIN rtop t ON s.run_date = t.run_date AND s.geo_country = t.geo_country
)"""

RCELLS = """
rcells AS (
  SELECT run_date, is_new_user, device, geo, count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n1,
    CAST(sum(outcome) AS BIGINT) AS y, CAST(sum(treatment * outcome) AS BIGINT) AS y1
  FROM rframe GROUP BY ALL
)"""

RSCORED = """
rscored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM rcells)"""

RSTATS = """
rstats AS (
  SELECT run_date, count(*) AS n_sessions, CAST(sum(treatment) AS BIGINT) AS n_paid,
    CAST(sum(outcome) AS BIGINT) AS n_converted,
    round(CAST(sum(treatment * outcome) AS DOUBLE) / nullif(sum(treatment), 0)
      - CAST(sum(outcome) - sum(treatment * outcome) AS DOUBLE) / nullif(count(*) - sum(treatment), 0), 9)
      AS naive_difference,
    min(session_date) AS data_start, max(session_date) AS data_end
  FROM rframe GROUP BY run_date
)"""


def _ests_sql() -> str:
    return (
        "ests AS ("
        f"SELECT run_date, 'propensity_score_matching' AS method, ate FROM ({matching_sql('rscored', 'run_date')}) "
        f"UNION ALL SELECT run_date, 'propensity_score_weighting', ate FROM ({ipw_sql('rscored', keys='run_date')}) "
        "UNION ALL SELECT run_date, 'propensity_score_stratification', ate FROM ("
        + stratified_sql('rscored', candidates=(50, 25, 12, 6, 3, 1), auto=True, keys='run_date') + "))")


HISTORY = """
history AS (
  SELECT e.method, e.ate, CAST(e.run_date + INTERVAL 1 DAY AS TIMESTAMP) AS run_at, s.naive_difference,
    s.n_sessions, s.n_paid, s.n_converted, s.data_start, s.data_end
  FROM ests e JOIN rstats s USING (run_date)
)"""


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def latest_sql() -> str:
    from liftlens.operators.reports import MATCHING, MATCHING_CAVEAT
    return f"""
latest AS (
  SELECT method, ate, naive_difference, naive_difference - ate AS implied_selection_bias,
    method = '{MATCHING}' AS is_outlier,
    CASE WHEN method = '{MATCHING}' THEN {_q(MATCHING_CAVEAT)} END AS method_caveat,
    n_sessions, n_paid, n_converted, data_start, data_end, run_at, CAST(run_at AS DATE) AS run_date
  FROM history QUALIFY row_number() OVER (PARTITION BY method ORDER BY run_at DESC) = 1
)"""


def summary_sql() -> str:
    from liftlens.operators.reports import KIND_GOVERNED, KIND_NAIVE, KIND_OUTLIER, NAIVE
    return f"""
summary AS (
  SELECT method AS estimate, ate AS conversion_lift,
    CASE WHEN is_outlier THEN {_q(KIND_OUTLIER)} ELSE {_q(KIND_GOVERNED)} END AS estimate_kind,
    is_outlier, method_caveat, n_sessions, data_start, data_end, run_at
  FROM latest
  UNION ALL
  SELECT '{NAIVE}', p.naive_difference, {_q(KIND_NAIVE)}, false, CAST(NULL AS VARCHAR),
    p.n_sessions, p.data_start, p.data_end, p.run_at
  FROM (SELECT arg_max({{'naive_difference': naive_difference, 'n_sessions': n_sessions,
          'data_start': data_start, 'data_end': data_end, 'run_at': run_at}}, (run_at, method)) AS p FROM latest)
)"""


def history_chain() -> tuple:
    return SESS + (RUNS, RSESSIONS, RTOP, RFRAME, RCELLS, RSCORED, RSTATS, _ests_sql(), HISTORY)


def latest_chain() -> tuple:
    return history_chain() + (latest_sql(),)


def summary_chain() -> tuple:
    return latest_chain() + (summary_sql(),)


# --- quality, metrics, spine --------------------------------------------------

SPINE = """
spine AS (
  SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day
  FROM (SELECT min(event_date) AS a, max(event_date) AS b FROM stg)
)"""

MODEL_CTE = {"stg_ga4__events": "stg", "fct_sessions": "sessions", "fct_causal_estimates": "latest",
             "rpt_channel_performance": "channel", "rpt_causal_summary": "summary",
             "metricflow_time_spine": "spine"}


def quality_sql() -> str:
    from liftlens.operators.quality import DECLARED_TESTS
    parts = []
    for t in DECLARED_TESTS:
        src, c = MODEL_CTE[t.model], t.column
        if t.test == "not_null":
            f = f"(SELECT count(*) FROM {src} WHERE {c} IS NULL)"
        elif t.test == "unique":
            f = (f"(SELECT count(*) FROM (SELECT {c} FROM {src} WHERE {c} IS NOT NULL "
                 f"GROUP BY {c} HAVING count(*) > 1))")
        else:
            vals = ", ".join(_q(v) for v in t.values)
            f = f"(SELECT count(DISTINCT {c}) FROM {src} WHERE {c} NOT IN ({vals}))"
        parts.append(f"SELECT '{t.model}' AS model, '{c}' AS column_name, '{t.test}' AS test, "
                     f"CAST({f} AS BIGINT) AS failures")
    return " UNION ALL ".join(parts)


def quality_chain() -> tuple:
    return summary_chain() + (CHANNEL, SPINE)


# --- bootstrap and placebo ----------------------------------------------------

def boot_chain(replicates: int = 200, seed: int = 42) -> tuple:
    from liftlens.functions.hashing import sql_poisson1, sql_uniform
    u = sql_uniform(f"f.session_key || '|boot|' || CAST(r.replicate // 4 AS VARCHAR) || '|{seed}'",
                    "r.replicate % 4")
    boot = f"""
bw AS (
  SELECT f.*, r.replicate, {sql_poisson1(u)} AS w
  FROM frame f, (SELECT CAST(unnest(range({replicates})) AS INTEGER) AS replicate) r
)"""
    bcells = """
bcells AS (
  SELECT replicate, is_new_user, device, geo, CAST(sum(w) AS BIGINT) AS n, CAST(sum(w * treatment) AS BIGINT) AS n1,
    CAST(sum(w * outcome) AS BIGINT) AS y, CAST(sum(w * treatment * outcome) AS BIGINT) AS y1
  FROM bw WHERE w > 0 GROUP BY ALL
)"""
    bscored = """
bscored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM bcells)"""
    reps = f"""
reps AS ({ipw_sql('bscored', keys='replicate')})"""
    return FRAMED + (boot, bcells, bscored, reps)


def bootstrap_ci_sql() -> str:
    point = ipw_sql("scored")
    return (f"SELECT p.ate, round(q[1], 9) AS ci_low, round(q[2], 9) AS ci_high, round(sd, 9) AS sd, "
            f"share_positive, replicates FROM ({point}) p, "
            f"(SELECT quantile_cont(ate, [0.025, 0.975]) AS q, stddev_samp(ate) AS sd, "
            f"avg(CAST(ate > 0 AS DOUBLE)) AS share_positive, count(*) AS replicates FROM reps) s")


def placebo_chain(simulations: int = 10, seed: int = 42) -> tuple:
    from liftlens.functions.hashing import sql_uniform
    u = sql_uniform(f"f.session_key || '|placebo|' || CAST(s.sim AS VARCHAR) || '|{seed}'")
    perm = f"""
perm AS (
  SELECT f.*, s.sim, row_number() OVER (PARTITION BY s.sim ORDER BY {u}, f.session_key) AS rn,
    (SELECT sum(treatment) FROM frame) AS n1tot
  FROM frame f, (SELECT CAST(unnest(range({simulations})) AS INTEGER) AS sim) s
)"""
    pcells = """
pcells AS (
  SELECT sim, is_new_user, device, geo, count(*) AS n, CAST(sum(CASE WHEN rn <= n1tot THEN 1 ELSE 0 END) AS BIGINT) AS n1,
    CAST(sum(outcome) AS BIGINT) AS y, CAST(sum(CASE WHEN rn <= n1tot THEN outcome ELSE 0 END) AS BIGINT) AS y1
  FROM perm GROUP BY ALL
)"""
    pscored = """
pscored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM pcells)"""
    return FRAMED + (perm, pcells, pscored)


# --- orders domain -----------------------------------------------------------

ORDER_CHAIN = ("""
ret AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""", """
oframe AS (
  SELECT c.c_mktsegment, CAST(n.n_regionkey AS VARCHAR) AS n_regionkey, o.o_orderstatus,
    CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS treatment, CAST(r.l_orderkey IS NOT NULL AS INTEGER) AS outcome
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN ret r ON o.o_orderkey = r.l_orderkey
)""", """
ocells AS (
  SELECT c_mktsegment, n_regionkey, o_orderstatus, count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n1,
    CAST(sum(outcome) AS BIGINT) AS y, CAST(sum(treatment * outcome) AS BIGINT) AS y1
  FROM oframe GROUP BY ALL
)""", """
oscored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM ocells)""")


def window_sensitivity_sql() -> str:
    wcells = """
wcells AS (
  SELECT CAST(date_trunc('week', session_date) AS DATE) AS window_start, is_new_user, device, geo,
    count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n1, CAST(sum(outcome) AS BIGINT) AS y,
    CAST(sum(treatment * outcome) AS BIGINT) AS y1
  FROM frame GROUP BY ALL
)"""
    wscored = """
wscored AS (SELECT *, CAST(n1 AS DOUBLE) / n AS ps FROM wcells)"""
    ests = (
        f"SELECT window_start, 'propensity_score_matching' AS method, ate FROM ({matching_sql('wscored', 'window_start')}) "
        f"UNION ALL SELECT window_start, 'propensity_score_weighting', ate FROM ({ipw_sql('wscored', keys='window_start')}) "
        "UNION ALL SELECT window_start, 'propensity_score_stratification', ate FROM ("
        + stratified_sql('wscored', candidates=(50, 25, 12, 6, 3, 1), auto=True, keys='window_start') + ")")
    body = (f"SELECT e.window_start, e.method, e.ate, s.n_sessions, s.n_paid FROM ({ests}) e JOIN "
            "(SELECT window_start, CAST(sum(n) AS BIGINT) AS n_sessions, CAST(sum(n1) AS BIGINT) AS n_paid "
            "FROM wscored GROUP BY 1) s "
            "USING (window_start)")
    return with_(*FRAMED, wcells, wscored, body=body)


def single_run_sql(chain: tuple = SCORED_CHAIN) -> str:
    ests = (
        f"SELECT 'propensity_score_matching' AS method, ate FROM ({matching_sql('scored')}) "
        f"UNION ALL SELECT 'propensity_score_weighting', ate FROM ({ipw_sql('scored')}) "
        "UNION ALL SELECT 'propensity_score_stratification', ate FROM ("
        + stratified_sql('scored', candidates=(50, 25, 12, 6, 3, 1), auto=True) + ")")
    stats = ("SELECT count(*) AS n_sessions, CAST(sum(treatment) AS BIGINT) AS n_paid, "
             "CAST(sum(outcome) AS BIGINT) AS n_converted, "
             "round(CAST(sum(treatment * outcome) AS DOUBLE) / sum(treatment) - "
             "CAST(sum(outcome) - sum(treatment * outcome) AS DOUBLE) / (count(*) - sum(treatment)), 9) "
             "AS naive_difference, min(session_date) AS data_start, max(session_date) AS data_end FROM frame")
    body = (f"SELECT e.method, e.ate, CAST(s.data_end + INTERVAL 1 DAY AS TIMESTAMP) AS run_at, "
            f"s.naive_difference, s.n_sessions, s.n_paid, s.n_converted, s.data_start, s.data_end "
            f"FROM ({ests}) e, ({stats}) s")
    return with_(*chain, body=body)


def window_clip_sql(grid) -> str:
    wcells = """
wcells AS (
  SELECT CAST(date_trunc('week', session_date) AS DATE) AS window_start, is_new_user, device, geo,
    count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n1, CAST(sum(outcome) AS BIGINT) AS y,
    CAST(sum(treatment * outcome) AS BIGINT) AS y1
  FROM frame GROUP BY ALL
)"""
    values = ", ".join(f"(CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for lo, hi in grid)
    wscored = f"""
wscored AS (
  SELECT w.*, clip_lo, clip_hi, least(greatest(CAST(n1 AS DOUBLE) / n, clip_lo), clip_hi) AS ps
  FROM wcells w, (VALUES {values}) g(clip_lo, clip_hi)
)"""
    keys = "window_start, clip_lo, clip_hi"
    ests = (
        f"SELECT {keys}, 'propensity_score_matching' AS method, ate FROM ({matching_sql('wscored', keys)}) "
        f"UNION ALL SELECT {keys}, 'propensity_score_weighting', ate FROM ({ipw_sql('wscored', '0', '1', keys)}) "
        f"UNION ALL SELECT {keys}, 'propensity_score_stratification', ate FROM ("
        + stratified_sql('wscored', candidates=(50, 25, 12, 6, 3, 1), auto=True, keys=keys) + ")")
    return with_(*FRAMED, wcells, wscored, body=f"SELECT {keys}, method, round(ate, 9) AS ate FROM ({ests})")


# --- logit scores (C4): the same fixed number of Newton steps, relational ------------------

def logit_ctes(src: str, out: str, cats: tuple[str, ...], nums: tuple[str, ...], key: str = "") -> str:
    """CTEs from a cell table ``src`` to ``out``, the same cells with the logit score ``ps``."""
    from liftlens.operators.causal.propensity import DIGITS, MAX_MOVE, STEPS
    p, k = f"{out}_", key or "0"
    long = " UNION ALL ".join(
        [f"SELECT k, rid, 'a' AS c, CAST(1 AS DOUBLE) AS x FROM {p}base"]
        + [f"SELECT k, rid, 'b{i}', CAST({c} AS DOUBLE) FROM {p}base" for i, c in enumerate(nums)]
        + [f"SELECT k, rid, 'c{i}:' || {c}, CAST(1 AS DOUBLE) FROM {p}base WHERE {c} IS NOT NULL" for i, c in enumerate(cats)])
    ctes = [
        f"{p}base AS MATERIALIZED (SELECT {k} AS k, row_number() OVER () AS rid, * FROM {src})",
        f"{p}d AS MATERIALIZED (SELECT k, rid, dense_rank() OVER (PARTITION BY k ORDER BY c) - 1 AS j, x FROM ({long}))",
        f"{p}j AS MATERIALIZED (SELECT DISTINCT k, j FROM {p}d)",
        f"{p}pairs AS MATERIALIZED (SELECT d.k, d.rid, d.j AS a, e.j AS c, d.x * e.x AS xx FROM {p}d d JOIN {p}d e USING (k, rid))",
        f"{p}b0 AS MATERIALIZED (SELECT k, j, CASE WHEN j = 0 THEN ln((n1 + CAST(0.5 AS DOUBLE)) / (n - n1 + CAST(0.5 AS DOUBLE))) "
        f"ELSE 0 END AS b FROM {p}j JOIN (SELECT k, sum(n) AS n, sum(n1) AS n1 FROM {p}base GROUP BY k) USING (k))"]
    # elimination of the rows (matrix | right side): state and steps are structs of one type
    solve = ("list_reduce([{'j': i, 'm': CAST([] AS DOUBLE[][])} for i in range(1, len(m) + 1)], lambda acc, s: "
             "{'j': s.j, 'm': list_transform(acc.m, lambda r, i: CASE WHEN i = s.j THEN r ELSE list_transform(r, "
             "lambda v, q: v - acc.m[s.j][q] * (r[s.j] / acc.m[s.j][s.j])) END)}, {'j': CAST(0 AS BIGINT), 'm': m}).m")
    for s in range(STEPS):
        ctes += [
            f"{p}w{s} AS MATERIALIZED (SELECT k, rid, n * pr * (1 - pr) AS w, n1 - n * pr AS r FROM (SELECT d.k, d.rid, "
            f"1 / (1 + exp(-sum(d.x * b.b))) AS pr FROM {p}d d JOIN {p}b{s} b USING (k, j) GROUP BY ALL) JOIN {p}base USING (k, rid))",
            f"{p}h{s} AS (SELECT q.k, q.a, q.c, sum(w.w * q.xx) AS h FROM {p}pairs q JOIN {p}w{s} w USING (k, rid) GROUP BY ALL)",
            f"{p}g{s} AS (SELECT d.k, d.j, sum(w.r * d.x) AS g FROM {p}d d JOIN {p}w{s} w USING (k, rid) GROUP BY ALL)",
            f"{p}r{s} AS (SELECT u.k, u.j AS a, list(coalesce(h, 0) + CASE WHEN u.j = v.j AND u.j > 0 THEN 1 ELSE 0 END ORDER BY v.j) "
            f"AS h FROM {p}j u JOIN {p}j v USING (k) LEFT JOIN {p}h{s} q ON q.k = u.k AND q.a = u.j AND q.c = v.j GROUP BY ALL)",
            f"{p}m{s} AS (SELECT r.k, list(list_append(h, g - CASE WHEN a > 0 THEN b ELSE 0 END) ORDER BY a) AS m FROM {p}r{s} r "
            f"JOIN {p}g{s} g ON g.k = r.k AND g.j = a JOIN {p}b{s} b ON b.k = r.k AND b.j = a GROUP BY r.k)",
            f"{p}s{s} AS MATERIALIZED (SELECT k, generate_subscripts(m, 1) - 1 AS j, unnest(list_transform(m, lambda r, i: "
            f"r[-1] / r[i])) AS step FROM (SELECT k, {solve} AS m FROM {p}m{s}))",
            f"{p}b{s + 1} AS MATERIALIZED (SELECT k, j, b + step * least(1, {MAX_MOVE} / greatest(max(abs(step)) OVER (PARTITION BY k), "
            f"1e-300)) AS b FROM {p}b{s} JOIN {p}s{s} USING (k, j))"]
    ctes.append(
        f"{out} AS MATERIALIZED (SELECT base.* EXCLUDE (k, rid), ps FROM {p}base base JOIN (SELECT d.k, d.rid, "
        f"round(1 / (1 + exp(-sum(d.x * b.b))), {DIGITS}) AS ps FROM {p}d d JOIN {p}b{STEPS} b USING (k, j) GROUP BY ALL) USING (k, rid))")
    return "\n" + ",\n".join(ctes)


SESSION_LOGIT = (("device", "geo"), ("is_new_user",))
LOGIT_SCORED = logit_ctes("cells", "scored", *SESSION_LOGIT)
LOGIT_CHAIN = CELLED + (LOGIT_SCORED,)


def rounded_sql(sql: str, *cols: str, digits: int = 6) -> str:
    """``sql`` with columns rounded once more: sums of two engines agree to about 1e-12."""
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in cols)}) FROM ({sql})"


def placebo_logit_chain() -> tuple:
    *chain, _ = placebo_chain()
    return (*chain, logit_ctes("pcells", "pscored", *SESSION_LOGIT, key="sim"))


ORDER_LOGIT_CHAIN = ORDER_CHAIN[:3] + (logit_ctes("ocells", "oscored", ("c_mktsegment", "n_regionkey", "o_orderstatus"), ()),)
