"""A null segment is one like any other: rows in equal rows out."""

import math

import pytest
from pyspark.sql import functions as F

from forecastops.operators import drift as dr
from forecastops.operators import histograms as hi
from forecastops.operators import split as sp
from forecastops.operators.joins import null_safe_join


@pytest.fixture(scope="module")
def rows(spark):
    seg = F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 4 == 0, "a").otherwise("b"))
    return spark.range(400).select("id", seg.alias("seg"), (F.floor(F.col("id") / 40) % 10).cast("int").alias("week"), (F.col("id") * 37 % 50).cast("double").alias("v")).cache()


def test_histogram_counts_every_row(rows):
    edges = hi.bin_edges(rows, "seg", [], ["v"], 5, exact=True)
    hist = hi.histogram(rows, ["week"], "seg", ["v"], edges).collect()
    counts = {}
    for r in hist:
        counts[r.seg] = counts.get(r.seg, 0) + r.bin_count
    assert counts == {"a": 100, "b": 100, None: 200}


def test_holdout_keeps_every_row(rows):
    train, holdout = sp.clean_and_holdout(rows, "seg", "week", ["id"], "v", 0.3, 1.0)
    assert train.count() + holdout.count() == 400
    assert holdout.where("seg is null").count() > 0 and "cutoff_week" not in train.columns


@pytest.mark.parametrize("missing", ["ignore", "zero"])
def test_psi_of_a_null_segment_equals_that_of_a_named_one(rows, missing):
    def values(df):
        shares = hi.proportions(df.where("not (week = 7 and coalesce(seg, 'n') = 'n')"), ["week"], "seg")
        return {r.week: r.psi for r in dr.psi(shares.where("week >= 5"), shares.where("week < 5"), "seg", ["week"], missing=missing).collect()}

    plain, named = values(rows), values(rows.fillna({"seg": "n"}))
    assert plain.keys() == named.keys() and all(math.isclose(plain[w], named[w], abs_tol=1e-12) for w in plain)
    assert (plain[7] > 1) == (missing == "zero")


def test_js_of_a_null_segment(rows):
    def values(df):
        edges = hi.bin_edges(df, "seg", [], ["v"], 4, exact=True)
        hist = hi.histogram(df, ["week"], "seg", ["v"], edges)
        found = dr.js_distance(hist.where("week >= 5"), hist.where("week < 5"), ["week"], ["seg", "feature"])
        return {(r.week, r.seg or "n"): round(r.js_distance, 9) for r in found.collect()}

    assert values(rows) == values(rows.fillna({"seg": "n"}))


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None, "l1"), (None, "x", "l2"), (3, "y", "l3")], "k int, s string, l string")
    right = spark.createDataFrame([(1, None, "r1"), (None, "x", "r2"), (4, None, "r4")], "k int, s string, r string")
    got = lambda how: sorted(map(tuple, null_safe_join(left, right, ["k", "s"], how).collect()), key=str)
    assert got("inner") == [(1, None, "l1", "r1"), (None, "x", "l2", "r2")]
    assert got("full") == [(1, None, "l1", "r1"), (3, "y", "l3", None), (4, None, None, "r4"), (None, "x", "l2", "r2")]
    assert got("left_anti") == [(3, "y", "l3")] and len(got("left")) == 3 and len(got("left_semi")) == 2
