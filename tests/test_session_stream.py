"""Sessions from a stateful stream: micro-batches, restart, replay, failures, folding, watermark."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from liftlens.operators.flatten import flatten_events
from liftlens.operators.sessions import SESSION_COLUMNS, session_partials, sessionize
from liftlens.plans import models as M
from liftlens.sources.versions import current
from liftlens.streaming import session_stream
from liftlens.streaming.session_stream import (PART, apply_epoch, compact, read_event_files, read_partials, read_sessions,
                                               stream_sessions)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*SESSION_COLUMNS).collect()), key=repr)


def _arrive(raw, path, files=1):
    raw.repartition(files, "event_id").write.mode("append").parquet(path)


def test_several_batches_and_a_restart_equal_the_batch_mart(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    arrived, root, state = (f"{workdir}/{x}" for x in ("arrived", "partials", "state"))
    seen = None
    for third in range(3):
        some = raw.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == third)
        seen = some if seen is None else seen.unionByName(some)
        _arrive(some, arrived, 2)
        run = stream_sessions(read_event_files(spark, arrived, 1), root, state)
        assert run.batches == 2 and run.late == 0
        assert _rows(read_sessions(spark, root)) == _rows(sessionize(flatten_events(seen)))
    # nothing new: nothing changes
    held = current(spark, root)
    assert stream_sessions(read_event_files(spark, arrived, 1), root, state).batches == 0
    assert current(spark, root) == held
    # folded in one step, and the stream goes on after it
    before = _rows(read_sessions(spark, root))
    assert compact(spark, root) == 6 and len(current(spark, root)) == 1 and compact(spark, root) == 0
    assert _rows(read_sessions(spark, root)) == before
    extra = raw.limit(5).withColumns({"event_id": F.lit(10 ** 12) + F.col("event_id"), "event_name": F.lit("purchase")})
    _arrive(extra, arrived)
    assert stream_sessions(read_event_files(spark, arrived), root, state).batches == 1
    full = spark.read.schema(raw.schema).parquet(arrived)
    assert _rows(read_sessions(spark, root)) == _rows(sessionize(flatten_events(full))) != before
    # a new checkpoint reads its source from the beginning and takes the table over
    assert stream_sessions(read_event_files(spark, arrived), root, f"{state}-2").batches == 1
    assert len(current(spark, root)) == 1
    assert _rows(read_sessions(spark, root)) == _rows(sessionize(flatten_events(full)))


def test_a_replayed_epoch_changes_nothing(spark, workdir):
    stg, root = M.staging(spark, SF_SMALL), f"{workdir}/partials"
    early = session_partials(stg.where("event_id % 2 = 0"))
    assert apply_epoch(early, 0, "q", root) and apply_epoch(session_partials(stg), 1, "q", root)
    held, rows = current(spark, root), _rows(read_sessions(spark, root))
    assert rows == _rows(sessionize(stg))
    for epoch in (0, 1):
        assert not apply_epoch(early, epoch, "q", root)
    compact(spark, root)
    assert not apply_epoch(early, 1, "q", root)          # also when its part has been folded
    assert held != current(spark, root) and _rows(read_sessions(spark, root)) == rows
    # a micro-batch without a change is entered in the ledger
    assert apply_epoch(early.limit(0), 2, "q", root) and not apply_epoch(early, 2, "q", root)
    assert _rows(read_sessions(spark, root)) == rows


def test_a_batch_that_dies_before_its_version_file_is_replayed(spark, workdir, monkeypatch):
    raw = M.raw_events(spark, SF_SMALL)
    arrived, root, state = (f"{workdir}/{x}" for x in ("arrived", "partials", "state"))
    _arrive(raw.where("event_id % 2 = 0"), arrived)
    stream_sessions(read_event_files(spark, arrived), root, state)
    before = _rows(read_sessions(spark, root))
    _arrive(raw.where("event_id % 2 = 1"), arrived)

    def dies(*_, **__):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(session_stream, "publish", dies)
        with pytest.raises(Exception, match="lost"):
            stream_sessions(read_event_files(spark, arrived), root, state)
    assert _rows(read_sessions(spark, root)) == before
    assert stream_sessions(read_event_files(spark, arrived), root, state).batches == 1
    assert _rows(read_sessions(spark, root)) == _rows(M.sessions(spark, SF_SMALL))

    # published, but the stream died before it noted so: the replay finds its epoch
    _arrive(raw.limit(3).withColumn("event_id", F.lit(10 ** 12) + F.col("event_id")), arrived)
    publish = session_stream.publish

    def publishes_and_dies(*a, **k):
        publish(*a, **k)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(session_stream, "publish", publishes_and_dies)
        with pytest.raises(Exception, match="lost"):
            stream_sessions(read_event_files(spark, arrived), root, state)
    held = current(spark, root)
    assert stream_sessions(read_event_files(spark, arrived), root, state).batches == 0
    assert current(spark, root) == held


def test_events_later_than_max_delay_are_counted(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    days = sorted(r[0] for r in raw.select("event_date").distinct().collect())
    arrived, root, state = (f"{workdir}/{x}" for x in ("arrived", "partials", "state"))
    parts = [raw.where(F.col("event_date").isin(days[2:12])), raw.where(F.col("event_date") == days[11]),
             raw.where(F.col("event_date") == days[10]), raw.where(F.col("event_date") == days[0])]
    late = []
    for i, some in enumerate(parts):
        _arrive(some.withColumn("event_id", F.col("event_id") + i * 10 ** 12), arrived)
        late.append(stream_sessions(read_event_files(spark, arrived), root, state, "3 days").late)
    # the day within three days counts, the first day is past and reported
    assert late[:3] == [0, 0, 0] and late[3] == parts[3].where("true").transform(flatten_events).select(
        "event_date_key", "session_key", "user_pseudo_id").distinct().count() > 0
    kept = spark.read.schema(raw.schema).parquet(arrived).where(F.col("event_date") != days[0])
    assert _rows(read_sessions(spark, root)) == _rows(sessionize(flatten_events(kept)))


def test_odd_events(spark, workdir):
    raw = M.raw_events(spark, SF_SMALL)
    arrived, root = f"{workdir}/arrived", f"{workdir}/partials"
    odd = raw.limit(40).withColumns({
        "event_date": F.when(F.col("event_id") % 2 == 0, F.col("event_date")),
        "user_pseudo_id": F.when(F.col("event_id") % 3 > 0, F.col("user_pseudo_id")),
        "ecommerce": F.when(F.col("event_id") % 5 > 0, F.col("ecommerce"))})
    _arrive(odd.unionByName(odd), arrived, 3)
    _arrive(raw.limit(0), arrived)
    stream_sessions(read_event_files(spark, arrived, 1), root, f"{workdir}/state")
    assert _rows(read_sessions(spark, root)) == _rows(sessionize(flatten_events(odd.unionByName(odd))))
    with pytest.raises(Exception, match="without a date"):
        stream_sessions(read_event_files(spark, arrived), f"{root}-2", f"{workdir}/state-2", "3 days")


def test_reading_sessions_is_one_shuffle(spark, workdir):
    stg, root = M.staging(spark, SF_SMALL), f"{workdir}/partials"
    for epoch in (0, 1):
        apply_epoch(session_partials(stg), epoch, "q", root)
    p = read_sessions(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert PART not in read_partials(spark, root).columns
