"""The daily pipeline as plain functions (replaces the scheduler DAG).

``run_day`` = land shard (S3) -> flatten + partition replace (F1-F5, S5) ->
session rebuild (A1, S8) -> pre-causal data tests + gate (Q1-Q5) -> channel
report (A8) -> causal estimates (C1-C13) -> estimate sink (S11) -> report views
(R1, R2) -> post-causal tests.  Each stage boundary that is reused later is a
table written below the shared folder, which also cuts the lineage: a lost
executor only recomputes from the last written table.

``backfill`` lands and loads a range of days in one job per stage (the
result equals a day-by-day catch-up run, see tests) and rebuilds once.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.operators.causal.encode import model_frame
from liftlens.operators.causal.results import REFERENCE_METHODS, causal_estimates
from liftlens.operators.metrics import spine_from, validate
from liftlens.operators.quality import DECLARED_TESTS, gate, run_tests
from liftlens.operators.reports import causal_summary, channel_performance, latest_estimates
from liftlens.operators.sessions import sessionize
from liftlens.plans.incremental import read_sessions, update_sessions
from liftlens.sources.shards import land_shards, load_staging, read_rejects, read_staging, write_table
from liftlens.sources.sinks import read_estimates, write_estimates

PRE_CAUSAL = ("stg_ga4__events", "fct_sessions", "rpt_channel_performance", "metricflow_time_spine")
POST_CAUSAL = ("fct_causal_estimates", "rpt_causal_summary")


@dataclass
class PipelineConfig:
    root: str                                   # shared folder for all tables
    key_range: tuple[int, int] | None = None    # declared staging partition range
    methods: tuple[str, ...] = REFERENCE_METHODS
    model: str = "logit"
    null_treatment: str = "error"
    estimates_mode: str = "truncate"
    enforce_tests: bool = True
    skip_tests: tuple[str, ...] = field(default_factory=tuple)   # e.g. ("fct_sessions.is_paid",)
    incremental_sessions: bool = False          # X2: keep per-day partials, merge them

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)


def _tests_for(models: tuple[str, ...], skip: tuple[str, ...]):
    return tuple(t for t in DECLARED_TESTS
                 if t.model in models and f"{t.model}.{t.column}" not in skip)


def rebuild_marts(spark: SparkSession, cfg: PipelineConfig, days: list[str] | None = None) -> dict[str, DataFrame]:
    """Rebuild the session mart (sessions span midnight, so never append).

    Full rebuild re-aggregates all staged events.  With
    ``incremental_sessions`` only the loaded days' per-day partials are
    recomputed, and only the buckets of the mart that they touch are merged and
    replaced (``incremental.py``).
    """
    stg = read_staging(spark, cfg.path("stg"))
    if cfg.incremental_sessions:
        keys = None if days is None else [int(d) for d in days]
        update_sessions(read_staging(spark, cfg.path("stg"), keys), cfg.path("session_partials"),
                        cfg.path("fct_sessions"), keys)
        sessions = read_sessions(spark, cfg.path("fct_sessions"))
    else:
        write_table(sessionize(stg), cfg.path("fct_sessions"))
        sessions = spark.read.parquet(cfg.path("fct_sessions"))
    return {"stg_ga4__events": stg, "fct_sessions": sessions,
            "rpt_channel_performance": channel_performance(sessions),
            "metricflow_time_spine": spine_from(stg, "event_date")}


def causal_step(spark: SparkSession, cfg: PipelineConfig, sessions: DataFrame, run_at) -> dict[str, DataFrame]:
    frame = model_frame(sessions, null_treatment=cfg.null_treatment)
    write_estimates(causal_estimates(frame, run_at, cfg.methods, cfg.model), cfg.path("causal_estimates"),
                    mode=cfg.estimates_mode)
    latest = latest_estimates(read_estimates(spark, cfg.path("causal_estimates")))
    return {"fct_causal_estimates": latest, "rpt_causal_summary": causal_summary(latest)}


def run_day(spark: SparkSession, raw_events: DataFrame, ds: str, cfg: PipelineConfig,
            run_at=None) -> dict[str, DataFrame]:
    """One logical day: the shard ``ds`` (YYYYMMDD) is landed and loaded, marts rebuilt."""
    return backfill(spark, raw_events, [ds], cfg, run_at)


def backfill(spark: SparkSession, raw_events: DataFrame, days: list[str], cfg: PipelineConfig,
             run_at=None) -> dict[str, DataFrame]:
    land_shards(raw_events, cfg.path("raw"), days=list(days))
    load_staging(spark, cfg.path("raw"), cfg.path("stg"), days=list(days), key_range=cfg.key_range,
                 rejects_root=cfg.path("stg_rejects"))
    models = rebuild_marts(spark, cfg, list(days))
    models["stg_rejects"] = read_rejects(spark, cfg.path("stg_rejects"))
    report = run_tests({k: models[k] for k in PRE_CAUSAL}, _tests_for(PRE_CAUSAL, cfg.skip_tests))
    if cfg.enforce_tests:
        gate(report)
    if run_at is None:
        run_at = F.timestamp_add("DAY", F.lit(1), F.to_timestamp_ntz(F.lit(max(days)), F.lit("yyyyMMdd")))
    models.update(causal_step(spark, cfg, models["fct_sessions"], run_at))
    post = run_tests({k: models[k] for k in POST_CAUSAL}, _tests_for(POST_CAUSAL, cfg.skip_tests))
    if cfg.enforce_tests:
        gate(post)
    models["quality_report"] = report.unionByName(post)
    # last step: the governed metrics still find their tables and columns (M9)
    validate({"sessions": models["fct_sessions"], "causal_estimates": models["fct_causal_estimates"]})
    return models


def catchup(spark: SparkSession, raw_events: DataFrame, days: list[str], cfg: PipelineConfig,
            ) -> dict[str, DataFrame]:
    """Run ``run_day`` for each logical day in order, one run at a time (the
    scheduled catch-up).  With ``estimates_mode='append'`` every run adds its
    estimate rows, so the latest-per-method view picks the last run."""
    out: dict[str, DataFrame] = {}
    for ds in sorted(days):
        out = run_day(spark, raw_events, ds, cfg)
    return out
