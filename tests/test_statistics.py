"""Row counts, ranges and null counts from footers: equal to the rows, without a data page."""

import glob
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from liftlens.operators.metrics import spine_from, spine_from_statistics
from liftlens.operators.quality import not_null_columns, run_tests
from liftlens.operators.reports import null_profile, null_profile_from_statistics, table_shape, table_shape_from_statistics
from liftlens.plans import models as M
from liftlens.sources import footers
from liftlens.sources.footers import data_files
from liftlens.sources.shards import land_shards, read_shards, shard_row_counts
from liftlens.sources.statistics import partition_row_counts, table_statistics


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _blank_data(folder):
    """Overwrite everything between the magic number and the footer of every file below a folder."""
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        data = open(path, "rb").read()
        footer = 8 + struct.unpack("<I", data[-8:-4])[0]
        with open(path, "wb") as f:
            f.write(data[:4] + b"\0" * (len(data) - 4 - footer) + data[-footer:])
        for crc in glob.glob(f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.crc"):
            open(crc, "wb").close()


def test_shard_counts_of_landings_and_of_plain_folders(spark, workdir):
    raw, ours, plain = M.raw_events(spark, SF_SMALL), f"{workdir}/ours", f"{workdir}/plain"
    days = sorted(r[0] for r in raw.select("event_date").distinct().collect())
    land_shards(raw, ours, files_per_day=2)
    land_shards(raw.where(F.col("event_id") % 2 == 0), ours, days=days[:3], files_per_day=1)    # landed again
    land_shards(raw.limit(0), ours, days=days[5:6])                                             # emptied
    null_day = raw.withColumn("shard", F.when(F.col("event_date") > days[2], F.col("event_date")))
    null_day.write.partitionBy("shard").parquet(plain)
    for root, data in ((ours, f"{ours}/loads"), (plain, plain)):
        expected = _rows(shard_row_counts(read_shards(spark, root)))
        _blank_data(data)
        assert _rows(partition_row_counts(spark, root)) == expected
        some = partition_row_counts(spark, root, values=[days[3], days[5]]).collect()
        assert sorted(some) == sorted(r for r in expected if r[0] in (days[3], days[5]))
    assert not partition_row_counts(spark, ours, values=["19990101"]).collect()


def test_reports_from_statistics_equal_those_from_rows(spark, workdir):
    mart, stg = M.sessions(spark, SF_SMALL), M.staging(spark, SF_SMALL)
    for df, name in ((mart, "mart"), (stg, "stg")):
        df.repartition(3, "session_key").write.parquet(f"{workdir}/{name}")
    files = {n: data_files(spark, f"{workdir}/{n}") for n in ("mart", "stg")}
    shape, nulls, spine = _rows(table_shape(mart)), _rows(null_profile(mart)), _rows(spine_from(stg, "event_date"))
    for n in files:
        _blank_data(f"{workdir}/{n}")
    found = table_statistics(spark, files["mart"], mart.schema, ("session_date",), [r[0] for r in nulls])
    assert _rows(table_shape_from_statistics(found)) == shape
    assert _rows(null_profile_from_statistics(found)) == nulls and any(r[1] for r in nulls)
    dates = table_statistics(spark, files["stg"], stg.schema, ranges=("event_date",))
    assert _rows(spine_from_statistics(dates, "event_date")) == spine


def test_not_null_tests_from_statistics(spark, workdir):
    rows = [("k1", 1, None, True, "desktop"), ("k1", None, True, True, "tv"), (None, 3, None, False, None)]
    df = spark.createDataFrame(rows, "session_key string, session_date_key long, is_paid boolean, converted boolean, "
                                     "device_category string")
    df.write.parquet(f"{workdir}/m")
    from liftlens.operators.quality import DECLARED_TESTS
    tests = tuple(t for t in DECLARED_TESTS if t.model == "fct_sessions")
    model = {"fct_sessions": spark.read.parquet(f"{workdir}/m")}
    found = table_statistics(spark, data_files(spark, f"{workdir}/m"), df.schema, nulls=not_null_columns("fct_sessions"))
    report = run_tests(model, tests, {"fct_sessions": found})
    assert _rows(report) == _rows(run_tests(model, tests))
    assert {r.column_name: r.failures for r in report.collect() if r.test == "not_null"} == {
        "session_key": 1, "session_date_key": 1, "is_paid": 2, "converted": 0}


def test_files_without_statistics_are_read(spark, workdir, monkeypatch):
    import os
    os.makedirs(f"{workdir}/t")
    schema = pa.schema([("a", pa.int64()), ("s", pa.string())])
    tables = [([3, None, 9], ["x", None, None]), ([None, None], [None, "y"]), ([-4, 12], ["", "z"]), ([], [])]
    for i, (a, s) in enumerate(tables):
        pq.write_table(pa.table([pa.array(a, pa.int64()), pa.array(s, pa.string())], schema=schema),
                       f"{workdir}/t/f{i}.parquet", write_statistics=i != 2, row_group_size=2)
    files, typed = data_files(spark, f"{workdir}/t"), spark.read.parquet(f"{workdir}/t").schema
    expected = (7, -4, 12, 3, 3)
    assert tuple(table_statistics(spark, files, typed, ("a",), ("a", "s")).first()) == expected

    def refuse(path):
        raise OSError("not here")
    monkeypatch.setattr(footers, "_open", refuse)       # a store that only Spark opens
    assert tuple(table_statistics(spark, files, typed, ("a",), ("a", "s")).first()) == expected
    monkeypatch.undo()
    assert table_statistics(spark, files, typed).first().num_rows == 7
    assert tuple(table_statistics(spark, files[1:2], typed, ("a",), ("a",)).first()) == (2, None, None, 2)
    assert tuple(table_statistics(spark, [], typed, ("a",), ("a",)).first()) == (0, None, None, 0)


def test_what_footers_cannot_say_raises(spark, workdir):
    spark.createDataFrame([(1, "a")], "p int, s string").write.partitionBy("p").parquet(f"{workdir}/t")
    files, typed = data_files(spark, f"{workdir}/t"), spark.read.parquet(f"{workdir}/t").schema
    with pytest.raises(ValueError, match="bounds of"):
        table_statistics(spark, files, typed, ranges=("s",))
    with pytest.raises(ValueError, match="p is not stored"):
        table_statistics(spark, files, typed, nulls=("p",))
