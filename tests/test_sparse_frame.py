"""The wide model frame as a sparse vector: equal to the wide columns, any number of levels."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from liftlens.operators.causal.encode import (MAX_LEVELS, confounder_levels, confounder_names, one_hot, sparse_frame,
                                              vector_ones)
from liftlens.plans import models as M


def _frame(spark, rows):
    return spark.createDataFrame(rows, "session_key string, treatment int, outcome int, is_new_user int, device string, geo string")


def test_vector_components_are_the_wide_columns(spark):
    frame = M.frame(spark, SF_SMALL)
    levels = confounder_levels(frame)
    names = confounder_names(levels)
    wide = one_hot(frame, levels).select("session_key", F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("x"))
    sparse = sparse_frame(frame, levels).select("session_key", vector_to_array("features").alias("x"))
    key = lambda r: (r.session_key or "", r.x)
    assert sorted(wide.collect(), key=key) == sorted(sparse.collect(), key=key)


def test_as_many_levels_as_allowed_in_one_plan(spark):
    frame = spark.range(MAX_LEVELS).select(
        F.col("id").cast("string").alias("session_key"), (F.col("id") % 2).cast("int").alias("treatment"),
        F.lit(0).alias("outcome"), (F.col("id") % 3 == 0).cast("int").alias("is_new_user"),
        F.when(F.col("id") % 2 == 0, "mobile").otherwise("tablet").alias("device"),
        F.format_string("c%05d", F.col("id").cast("int")).alias("geo"))
    levels = confounder_levels(frame)
    found = sparse_frame(frame, levels)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    row = found.where("session_key = '6'").select(vector_ones().alias("at"), "features").first()
    assert row["at"] == [0, 1, 3 + 6] and row.features.size == 3 + MAX_LEVELS and len(row.features.indices) == 3
    assert found.agg(F.sum(F.size(vector_ones()))).first()[0] == 2 * MAX_LEVELS + len(range(0, MAX_LEVELS, 3))
    with pytest.raises(ValueError, match="more than"):
        sparse_frame(frame.unionByName(frame.withColumn("geo", F.lit("one more"))))


def test_odd_frames(spark):
    one = _frame(spark, [("a", 1, 0, 0, "mobile", "x"), ("a", 1, 0, 0, "mobile", "x"), (None, 0, 1, 1, "mobile", "x")])
    found = sparse_frame(one).select("session_key", vector_to_array("features").alias("x")).collect()
    assert sorted((r.session_key or "", r.x) for r in found) == [("", [1, 1, 1]), ("a", [0, 1, 1]), ("a", [0, 1, 1])]
    ones = sparse_frame(one).select(vector_ones().alias("at")).collect()
    assert sorted(r["at"] for r in ones) == [[0, 1, 2], [1, 2], [1, 2]]
    assert sparse_frame(_frame(spark, [])).collect() == []
    with pytest.raises(Exception, match="[Uu]nseen|label"):
        sparse_frame(_frame(spark, [("b", 0, 0, 0, "tv", "x")]), confounder_levels(one)).collect()
    with pytest.raises(ValueError, match="collide"):
        sparse_frame(_frame(spark, [("a", 1, 0, 0, "m", "x y"), ("b", 1, 0, 0, "m", "x_y")]))
