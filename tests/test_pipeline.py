"""Landing, incremental loads, streaming, the daily pipeline, quality gate and metrics."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from liftlens.operators.metrics import query_metrics, spine_from, validate
from liftlens.operators.quality import QualityGateError, gate, run_tests
from liftlens.operators.sessions import sessionize
from liftlens.plans import models as M
from liftlens.plans.pipeline import PipelineConfig, backfill, run_day
from liftlens.operators.flatten import flatten_events
from liftlens.schema import SchemaDriftError
from liftlens.session import shared_dir
from liftlens.sources import footers, shards, versions
from liftlens.sources.footers import data_files, file_schemas
from liftlens.sources.shards import (backfill as load_backfill, check_shards, land_shards, load_staging, read_rejects,
                                     read_shards, read_staging, replace_partitions, shard_days)
from liftlens.sources.versions import current, log, partition_paths, table_exists
from liftlens.streaming.shard_stream import stream_shards_to_staging


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def landed(spark):
    from liftlens.session import fresh_dir
    root = fresh_dir(spark, "landed")
    land_shards(M.raw_events(spark, SF_SMALL), f"{root}/raw", files_per_day=1)
    days = sorted(r[0] for r in read_shards(spark, f"{root}/raw").select("shard").distinct().collect())
    return root, f"{root}/raw", days


def test_shard_pruning_and_relanding(spark, landed):
    root, raw_root, days = landed
    one = read_shards(spark, raw_root, days[3])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and days[3] in plan
    before = _rows(read_shards(spark, raw_root))
    land_shards(M.raw_events(spark, SF_SMALL), raw_root, days=[days[3]], files_per_day=1)   # re-land one day
    assert _rows(read_shards(spark, raw_root)) == before


def test_incremental_is_idempotent_and_touches_only_its_days(spark, landed, workdir):
    _, raw_root, days = landed
    stg = f"{workdir}/stg"
    load_staging(spark, raw_root, stg, days=days[:5])
    held = current(spark, stg)
    first = _rows(read_staging(spark, stg).where(F.col("event_date_key") == int(days[0])))
    load_staging(spark, raw_root, stg, days=days[3:8])
    load_staging(spark, raw_root, stg, days=days[3:8])                     # re-run: same result
    now = current(spark, stg)
    assert all(now[d] == held[d] for d in days[:3]) and not any(now[d] == held[d] for d in days[3:5])
    assert _rows(read_staging(spark, stg).where(F.col("event_date_key") == int(days[0]))) == first
    full = M.staging(spark, SF_SMALL).where(F.col("event_date_key") <= int(days[7]))
    assert _rows(read_staging(spark, stg)) == _rows(full)


def test_day_by_day_equals_one_job(spark, landed, workdir):
    _, raw_root, days = landed
    load_backfill(spark, raw_root, f"{workdir}/a", days[:6], one_job=True)
    load_backfill(spark, raw_root, f"{workdir}/b", days[:6], one_job=False)
    assert _rows(read_staging(spark, f"{workdir}/a")) == _rows(read_staging(spark, f"{workdir}/b"))


def test_stream_in_several_batches_equals_batch(spark, landed, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    plain = f"{workdir}/plain"      # folders of another writer: a day's files are dealt to several micro-batches
    raw.withColumn("shard", F.col("event_date")).repartition(3).write.partitionBy("shard").parquet(plain)
    _, landed_root, days = landed
    ours = f"{workdir}/ours"        # our own landings, a day of them landed again
    for some in (days[:9], days[5:], days[2:3]):
        land_shards(raw, ours, days=some, files_per_day=1)
    for root, files in ((plain, 7), (ours, 1)):
        stg, ckpt = f"{root}-stg", f"{root}-ckpt"
        n = stream_shards_to_staging(spark, root, stg, ckpt, max_files_per_trigger=files)
        assert n > 1
        assert _rows(sessionize(read_staging(spark, stg))) == _rows(M.sessions(spark, SF_SMALL))
        # restart from the checkpoint: nothing new, nothing changes
        loads = current(spark, stg)
        assert stream_shards_to_staging(spark, root, stg, ckpt) == 0 and current(spark, stg) == loads
    # a day was loaded once, though its files came in several micro-batches
    assert len([e for e in log(spark, f"{plain}-stg") if e.value == days[4]]) == 1
    land_shards(raw.where(F.col("event_date") != days[4]), ours, days=[days[4]], files_per_day=1)
    assert stream_shards_to_staging(spark, ours, f"{ours}-stg", f"{ours}-ckpt") == 1
    assert read_staging(spark, f"{ours}-stg").where(F.col("event_date_key") == int(days[4])).count() == 0


def test_run_day_gate_and_pipeline(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    days = sorted(r[0] for r in raw.select("event_date").distinct().collect())
    cfg = PipelineConfig(root=f"{workdir}/p1", null_treatment="control")
    with pytest.raises(QualityGateError, match="is_paid"):
        backfill(spark, raw, days[:10], cfg)          # NULL treatment fails not_null(is_paid)
    cfg = PipelineConfig(root=f"{workdir}/p2", null_treatment="control", estimates_mode="append",
                         skip_tests=("fct_sessions.is_paid",), model="saturated")
    out = backfill(spark, raw, days[:10], cfg)
    out = run_day(spark, raw, days[10], cfg)
    est = out["fct_causal_estimates"].collect()
    assert {r.method for r in est} == {"propensity_score_matching", "propensity_score_weighting"}
    assert len({r.run_at for r in est}) == 1                  # latest run per method
    assert spark.read.parquet(cfg.path("causal_estimates")).count() == 4   # two runs appended
    summary = out["rpt_causal_summary"].collect()
    assert [r.estimate for r in summary if r.estimate == "naive_correlation"]
    assert out["quality_report"].where("failures > 0").count() == 0


def test_quality_detects_failures(spark):
    df = spark.createDataFrame([("a", "desktop"), ("a", "phone"), (None, None)], "session_key string, device_category string")
    from liftlens.operators.quality import ColumnTest
    tests = (ColumnTest("m", "session_key", "not_null"), ColumnTest("m", "session_key", "unique"),
             ColumnTest("m", "device_category", "accepted_values", ("desktop", "mobile", "tablet")))
    rep = {(r.test): r.failures for r in run_tests({"m": df}, tests).collect()}
    assert rep == {"not_null": 1, "unique": 1, "accepted_values": 1}
    with pytest.raises(QualityGateError):
        gate(run_tests({"m": df}, tests))


def test_metrics_validation_and_ratio(spark):
    s = M.sessions(spark, SF_SMALL)
    with pytest.raises(KeyError):
        validate({"sessions": s.drop("converted")}, ["conversion_rate"])
    by_dev = query_metrics({"sessions": s}, ["conversion_rate"], ["session__device_category"]).collect()
    total = query_metrics({"sessions": s}, ["sessions", "conversions"]).first()
    n = sum(r.conversion_rate * s.where(F.col("device_category") == r.session__device_category).count()
            for r in by_dev)
    assert n == pytest.approx(total.conversions)
    spine = spine_from(M.staging(spark, SF_SMALL), "event_date")
    filled = query_metrics({"sessions": s}, ["sessions"], ["metric_time__day"], spine=spine, fill_nulls_with=0)
    assert filled.count() == spine.count() and filled.where(F.col("sessions").isNull()).count() == 0


def test_incremental_session_partials_equal_full_rebuild(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    days = sorted(r[0] for r in raw.select("event_date").distinct().collect())
    common = dict(null_treatment="control", skip_tests=("fct_sessions.is_paid",), model="saturated",
                  enforce_tests=False)
    inc = PipelineConfig(root=f"{workdir}/inc", incremental_sessions=True, **common)
    full = PipelineConfig(root=f"{workdir}/full", **common)
    # day by day with a midnight-crossing session split over two runs, then a re-delivered day
    for chunk in (days[:4], days[4:9], days[2:3]):
        a = backfill(spark, raw, chunk, inc)["fct_sessions"]
        b = backfill(spark, raw, chunk, full)["fct_sessions"]
        assert _rows(a) == _rows(b)


def test_a_day_reads_and_replaces_touched_buckets_only(spark, workdir):
    from liftlens.plans import incremental as inc
    stg = M.staging(spark, SF_SMALL)
    days = sorted(r[0] for r in stg.select("event_date_key").distinct().collect())
    partials, mart = f"{workdir}/partials", f"{workdir}/mart"
    inc.update_sessions(stg, partials, mart)
    before = current(spark, mart)
    # a day delivered again: short of a user, with an event less of another, and with a new session
    day = stg.where(F.col("event_date_key") == days[4])
    users = [r[0] for r in day.select("user_pseudo_id").distinct().orderBy("user_pseudo_id").limit(3).collect()]
    few = day.where(F.col("user_pseudo_id").isin(users))
    inc.update_sessions(few, partials, mart, [days[4]])
    new = few.limit(1).withColumn("session_key", F.lit("new-1"))
    again = few.where(F.col("user_pseudo_id") != users[0]).unionByName(new)
    loads = current(spark, mart)
    touched = inc.update_sessions(again, partials, mart, [days[4]])
    assert 0 < len(touched) < 12
    now = current(spark, mart)
    assert {int(b) for b in now if now[b] != loads.get(b)} <= touched and {b for b in before if int(b) not in touched} <= set(now)
    assert all(now[b] == loads[b] for b in now if int(b) not in touched)
    # the plan of the merge names no other bucket's folder
    merged = inc.read_partials(spark, partials, touched)
    assert merged.inputFiles() and {int(f.split("/part=")[1].split("/")[0].split("-")[1]) for f in merged.inputFiles()} == touched
    want = sessionize(stg.where(F.col("event_date_key") != days[4]).unionByName(again))
    assert _rows(inc.read_sessions(spark, mart)) == _rows(want)
    # a day that lost all its events
    inc.update_sessions(again.limit(0), partials, mart, [days[4]])
    assert _rows(inc.read_sessions(spark, mart)) == _rows(sessionize(stg.where(F.col("event_date_key") != days[4])))


def test_catchup_appends_one_run_per_day(spark, workdir):
    from liftlens.plans.pipeline import catchup
    raw = M.raw_events(spark, SF_SMALL)
    days = sorted(r[0] for r in raw.select("event_date").distinct().collect())[:3]
    cfg = PipelineConfig(root=f"{workdir}/cu", null_treatment="control", estimates_mode="append",
                         skip_tests=("fct_sessions.is_paid",), model="saturated", enforce_tests=False)
    out = catchup(spark, raw, days, cfg)
    hist = spark.read.parquet(cfg.path("causal_estimates"))
    assert hist.count() == 2 * len(days)
    assert hist.select("run_at").distinct().count() == len(days)
    latest = out["fct_causal_estimates"].collect()
    assert {r.run_date.strftime("%Y%m%d") for r in latest} == {
        (__import__("datetime").datetime.strptime(days[-1], "%Y%m%d")
         + __import__("datetime").timedelta(days=1)).strftime("%Y%m%d")}


def test_reference_date_spine(spark):
    from liftlens.operators.metrics import date_spine
    s = date_spine(spark)
    assert s.count() == 92 and s.agg(F.countDistinct("date_day")).first()[0] == 92


def test_land_with_files_per_day_bounds_files(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    land_shards(raw, f"{workdir}/raw", files_per_day=2)
    folders = partition_paths(spark, f"{workdir}/raw", "shard")
    assert folders
    for folder in folders:
        assert 1 <= len(data_files(spark, folder)) <= 2
    assert _rows(read_shards(spark, f"{workdir}/raw").drop("shard")) == _rows(raw)


def test_relanded_day_that_became_empty_is_empty(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    land_shards(raw, f"{workdir}/raw", files_per_day=1)
    load_staging(spark, f"{workdir}/raw", f"{workdir}/stg")
    days = shard_days(spark, f"{workdir}/raw")
    before = read_staging(spark, f"{workdir}/stg").count()
    gone = read_staging(spark, f"{workdir}/stg").where(F.col("event_date_key") == int(days[2])).count()
    land_shards(raw.where(F.col("event_date") != days[2]), f"{workdir}/raw", days=[days[2]])
    load_staging(spark, f"{workdir}/raw", f"{workdir}/stg", days=[days[2]])
    assert gone > 0 and read_staging(spark, f"{workdir}/stg").count() == before - gone
    assert read_shards(spark, f"{workdir}/raw", days[2]).count() == 0


def test_rejects_are_written_and_returned(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    land_shards(raw, f"{workdir}/raw", files_per_day=1)
    days = shard_days(spark, f"{workdir}/raw")
    span = (int(days[0]), int(days[5]))
    out = load_staging(spark, f"{workdir}/raw", f"{workdir}/stg", days=days[:8], key_range=span)
    inside = read_staging(spark, f"{workdir}/stg").count()
    assert out.count() == read_rejects(spark, f"{workdir}/stg_rejects").count() > 0
    assert inside + out.count() == flatten_events(read_shards(spark, f"{workdir}/raw", days[:8])).count()


def test_schema_drift_of_shards_and_written_table(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    with pytest.raises(SchemaDriftError, match="extra"):
        land_shards(raw.withColumn("surprise", F.lit(1)), f"{workdir}/raw")
    with pytest.raises(SchemaDriftError, match="missing"):
        land_shards(raw.drop("geo"), f"{workdir}/raw")
    land_shards(raw, f"{workdir}/raw", files_per_day=1)
    day = shard_days(spark, f"{workdir}/raw")[0]
    one = raw.where(F.col("event_date") == day)
    folder = partition_paths(spark, f"{workdir}/raw", "shard", [day])[0]
    one.limit(1).drop("geo").write.mode("append").parquet(folder)      # one drifted file beside a good one
    with pytest.raises(SchemaDriftError, match=f"shard {day}.*missing"):
        load_staging(spark, f"{workdir}/raw", f"{workdir}/stg", days=[day])
    stg = flatten_events(raw).withColumn("old_column", F.lit("x"))
    stg.write.partitionBy("event_date_key").parquet(f"{workdir}/old")
    replace_partitions(stg, f"{workdir}/old_versions", "event_date_key")
    other = shard_days(spark, f"{workdir}/raw")[1]
    with pytest.raises(SchemaDriftError, match="written staging table"):
        load_staging(spark, f"{workdir}/raw", f"{workdir}/old", days=[other])
    with pytest.raises(SchemaDriftError, match="written staging table"):
        load_staging(spark, f"{workdir}/raw", f"{workdir}/old_versions", days=[other])


def test_a_day_of_eight_files_with_one_drifted(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    day = raw.agg(F.min("event_date")).first()[0]
    one = raw.where(F.col("event_date") == day)
    folder = f"{workdir}/raw/shard={day}"
    one.repartition(7).write.parquet(folder)
    files = data_files(spark, folder)
    assert [n for _, n, _ in file_schemas(spark, files)] == [len(files)]
    check_shards(spark, f"{workdir}/raw", [day])
    for bad in (one.drop("geo"), one.withColumn("x", F.lit(1)), one.withColumn("event_id", F.col("event_id").cast("int"))):
        root = f"{workdir}/bad-{len(bad.columns)}-{bad.schema['event_id'].dataType.simpleString()}"
        one.repartition(7).write.parquet(f"{root}/shard={day}")
        bad.limit(2).coalesce(1).write.mode("append").parquet(f"{root}/shard={day}")
        for days in (None, [day]):
            with pytest.raises(SchemaDriftError, match=f"shard {day}"):
                load_staging(spark, root, f"{workdir}/stg", days=days)
        assert not table_exists(spark, f"{workdir}/stg")


def test_footers_of_a_store_that_only_spark_opens(spark, workdir, monkeypatch):
    M.raw_events(spark, SF_SMALL).limit(50).repartition(2).write.parquet(f"{workdir}/f")
    files = data_files(spark, f"{workdir}/f")
    direct = footers.footers(spark, files, ("event_id",)).collect()
    shapes = file_schemas(spark, files)

    def refuse(path):
        raise OSError("not here")
    monkeypatch.setattr(footers, "_open", refuse)
    unread = footers.unreadable(spark, footers.footers(spark, files))
    assert sorted(unread) == files
    again = footers.footers(spark, files, ("event_id",), by_content=unread).collect()
    assert sorted(r[1:] for r in again) == sorted(r[1:] for r in direct) and sum(r.num_rows for r in again) == 50
    assert [x[:2] for x in file_schemas(spark, files)] == [x[:2] for x in shapes]


def test_failure_between_write_and_publish_leaves_the_old_state(spark, landed, workdir, monkeypatch):
    _, raw_root, days = landed
    stg = f"{workdir}/stg"
    load_staging(spark, raw_root, stg, days=days[:4], key_range=(0, 99999999))
    before, rejects = _rows(read_staging(spark, stg)), f"{stg}_rejects"

    def die(*a, **kw):
        raise RuntimeError("executor farm on fire")
    with monkeypatch.context() as m:
        m.setattr(shards, "publish", die)
        for kw in ({"days": days[2:8]}, {"days": days[2:8], "full_refresh": True}, {"days": days[:4], "key_range": (0, 1)}):
            with pytest.raises(RuntimeError, match="fire"):
                load_staging(spark, raw_root, stg, **kw)
            assert _rows(read_staging(spark, stg)) == before and read_rejects(spark, rejects).count() == 0
    load_staging(spark, raw_root, stg, days=days[2:8], full_refresh=True)
    assert {str(r.event_date_key) for r in read_staging(spark, stg).select("event_date_key").distinct().collect()} == set(days[2:8])


def test_two_loads_of_one_version_do_not_hide_each_other(spark, workdir):
    from liftlens.sources.versions import publish, stage
    df = spark.range(6).withColumn("part", F.col("id") % 2)
    a, b = stage(df, f"{workdir}/t", "part"), stage(df.where("part = 1"), f"{workdir}/t", "part")
    publish(spark, a)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(versions, "log", lambda *x: None)      # the second loader has not seen the first one's version
        with pytest.raises(Exception, match="(?i)exists"):
            publish(spark, b)
    assert set(current(spark, f"{workdir}/t").values()) == {a.load}
    null = spark.createDataFrame([(1, None), (2, 7)], "id long, part long")
    publish(spark, stage(null, f"{workdir}/t", "part"), [0])
    read = versions.read_table(spark, f"{workdir}/t", "part", null.schema)
    assert sorted(map(tuple, read.collect()), key=repr) == [(1, 1), (1, None), (2, 7), (3, 1), (5, 1)]
    assert versions.read_table(spark, f"{workdir}/t", "part", null.schema, [None]).collect()[0].id == 1


def test_files_of_a_day_follow_its_bytes(spark, workdir):
    """By default large days get more files, small ones one; no setting is needed."""
    wide = M.raw_events(spark, SF_SMALL).repartition(8).withColumn(
        "event_name", F.concat_ws("-", *[F.sha2(F.concat("event_id", F.lit(str(i))), 512) for i in range(8)]))
    hot = F.when(F.col("event_id") % 8 > 0, "20240101").otherwise(F.col("event_date"))
    days = wide.withColumn("event_date", hot)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        land_shards(days, f"{workdir}/raw")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    n = {p.rsplit("=", 1)[1]: len(data_files(spark, p)) for p in partition_paths(spark, f"{workdir}/raw", "shard")}
    assert n["20240101"] > 2 * n["20240103"]


def test_subcent_revenue_is_kept(spark):
    rows = M.staging(spark, SF_SMALL).limit(1000).withColumn("purchase_revenue_usd", F.lit(0.004)).withColumn(
        "session_key", F.lit("one")).withColumn("user_pseudo_id", F.lit("u"))
    n = rows.count()
    assert sessionize(rows).first().session_revenue_usd == pytest.approx(0.004 * n, abs=1e-12)


def test_shared_root_is_stable(spark):
    assert shared_dir(spark, "x") == shared_dir(spark, "x")
