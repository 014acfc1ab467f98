"""No operator drops or doubles rows for null keys, unknown segments, late rows or large offsets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from forecastops import session
from forecastops.operators import feature_store as fs
from forecastops.operators import histograms as hi
from forecastops.operators import ranking as rk
from forecastops.operators import split as sp
from forecastops.operators import training as tr
from forecastops.sources import landing as la


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_keeps_null_partitions_and_keys(spark, folder):
    schema = "k int, p string, v int"
    path = f"{folder}/t"
    la.upsert_path(spark, path, spark.createDataFrame([(1, None, 1), (2, "a", 2), (None, "a", 3)], schema), ["k", "p"], ["p"])
    for _ in range(2):
        la.upsert_path(spark, path, spark.createDataFrame([(2, None, 4), (None, "a", 5)], schema), ["k", "p"], ["p"])
    got = spark.read.schema(schema).parquet(path).select("k", "p", "v")
    assert _rows(got) == _rows(spark.createDataFrame([(1, None, 1), (2, None, 4), (2, "a", 2), (None, "a", 5)], schema))


def test_upsert_reads_touched_partitions_only(spark, folder):
    path = f"{folder}/t"
    spark.range(400).selectExpr("id as k", "cast(id % 20 as int) as p").write.partitionBy("p").parquet(path)
    touched = spark.createDataFrame([(3,), (7,)], "p int")
    scan = spark.read.parquet(path).where(la.among(touched))
    assert len(scan.inputFiles()) > 0
    plan = scan._sc._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*p#\d+ (IN|INSET)", plan)
    assert {r.p for r in scan.select("p").distinct().collect()} == {3, 7}
    assert len({f for f in scan.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}) <= 2 * 8
    with pytest.raises(ValueError, match="distinct values"):
        la.among(spark.range(5), 4)
    two = spark.createDataFrame([(1, None), (None, "b")], "a int, b string")
    assert _rows(spark.createDataFrame([(1, None), (1, "b"), (None, "b"), (None, None)], "a int, b string").where(la.among(two))) == _rows(two)


def test_write_by_segment_with_null_segment(spark, folder):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "v int, s string")
    for _ in range(2):
        la.write_by_segment(spark, df, f"{folder}/s", "s")
    assert spark.read.parquet(f"{folder}/s").count() == 3


def test_temporal_split_keeps_rows_without_week(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, None, 1, 2, 3, 4]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "seg string, week int, id int")
    for by in ("row", "week"):
        out = sp.temporal_split(df, "seg", "week", ["id"], by=by)
        assert out.count() == len(rows)
    got = {(r.seg, r.id): r.is_test for r in sp.temporal_split(df, "seg", "week", ["id"]).collect()}
    for seg in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == seg), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[(seg, r[2])] for r in own] == [i >= int(len(own) * 0.8) for i in range(len(own))]


@pytest.mark.parametrize("group", [["g"], []])
def test_ntile_equals_the_window(spark, group):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, 0.0, 1.0, 1.0, 2.0, float("nan"), rng.random()]), i) for i in range(400)]
    rows += [("same", 5.0, 1000 + i) for i in range(50)] + [("few", float(i), 2000 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    want = df.withColumn("t", F.ntile(4).over((Window.partitionBy("g") if group else Window.partitionBy(F.lit(1))).orderBy("v", "id")))
    got = rk.add_ntile(df, group, ["v", "id"], 4, "t", window_rows=0)
    assert {r.id: r.t for r in got.collect()} == {r.id: r.t for r in want.collect()}


def test_quantiles_do_not_depend_on_size(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice("abc"), rng.gauss(0, 1e3)) for _ in range(3000)], "g string, v double")
    probs = [i / 20 for i in range(1, 20)]
    small = {r.g: r.qs for r in rk.quantiles(df, ["g"], "v", probs).collect()}
    large = {r.g: r.qs for r in rk.quantiles(df, ["g"], "v", probs, value_pairs=10).collect()}
    assert small == large


def test_fit_with_large_offsets(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=2000)
    y = 3 * x + rng.normal(scale=2, size=2000)
    df = spark.createDataFrame([("s", float(a + 1e7), float(b + 1e7)) for a, b in zip(x, y)], "seg string, x double, y double")
    r = tr.grouped_fit(df, "seg", ["x"], "y").first()
    slope = np.polyfit(x, y, 1)[0]
    assert abs(r.coefficients[0] - slope) < 1e-6
    assert abs(r.train_rmse - np.std(y - np.polyval(np.polyfit(x, y, 1), x))) < 1e-6


def test_trees_and_unknown_segments(spark):
    df = spark.createDataFrame([(s, float(i % 7), float(i % 7) * 2) for i in range(60) for s in ("a", "b", None)], "seg string, x double, y double")
    models = tr.fit_trees(df, "seg", ["a"], ["x"], "y", maxIter=2)
    out = tr.score_trees(df, "seg", models, ["x"], unknown="null")
    assert out.count() == 180 and out.where("prediction is null").count() == 120
    with pytest.raises(Exception, match="no model for segment"):
        tr.score_trees(df, "seg", models, ["x"]).collect()


def test_rows_that_arrive_after_their_batch(spark, folder):
    compute = lambda rows: rows.groupBy("c").agg(F.sum("v").alias("v"))
    schema = "c string, v int"
    for part in ([("a", 1)], [("b", 2)], [("b", 2)], [("a", 1), ("b", 2), ("b", 5)]):
        fs.run_batch(spark, spark.createDataFrame(part, schema), "b1", compute, folder, ["c"])
    assert _rows(spark.read.parquet(f"{folder}/history").select("c", "v")) == [("a", 1), ("b", 7)]
    assert _rows(fs.read_latest(spark, folder).select("c", "v")) == [("a", 1), ("b", 7)]


def test_segments_left_out_of_a_search_are_named(spark):
    rows = [("big", i, i >= 80) for i in range(100)] + [("few", i, False) for i in range(10)] + [("young", i, i >= 5) for i in range(60)]
    df = spark.createDataFrame([(s, float(i), float(i), t) for s, i, t in rows], "seg string, x double, y double, is_test boolean")
    searched = {r.seg for r in tr.trial_search(df, "seg", ["x"], "y", tr.draw_trials(["x"], 2)).collect()}
    left = {r.seg: r.reason for r in tr.unsearched_segments(df, "seg", "y").collect()}
    assert searched == {"big"} and left == {"few": "rows", "young": "sample"}


def test_wide_sides_are_not_broadcast(spark):
    wide = spark.range(100).select("id", F.array_repeat(F.lit(1.5), 1000).alias("edges"))
    assert "broadcast" in _plan(session.small_side(wide)).lower()
    assert "broadcast" not in _plan(session.small_side(wide, max_bytes=100_000)).lower()


def _plan(df):
    other = df.sparkSession.range(5).withColumnRenamed("id", "k")
    joined = other.join(df, F.col("k") == F.col("id"))
    return joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "extended").split("== Physical")[0]


def test_columns_with_few_values_are_counted_exactly(spark):
    df = spark.range(4000).select((F.col("id") % 19).alias("low"), (F.col("id") % 20).alias("high"), (F.col("id") % 210).alias("far"), F.lit(1).alias("one"))
    assert hi.monitored_columns(df) == {"low": ["low"], "high": ["high", "far"]}
