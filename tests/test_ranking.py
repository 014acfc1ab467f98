"""Positions, n-tiles and quantiles against windows and numpy, with a group that holds most rows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from forecastops.operators.ranking import add_ntile, number_rows, quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: one group with two thirds of them, small groups, a null group, many ties."""
    g = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 300 == 0, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
    return spark.range(3000).select("id", g.alias("g"), (F.col("id") * 7919 % 40).cast("double").alias("v"))


def test_number_rows_equals_window(skewed):
    w = Window.partitionBy("g").orderBy("v", "id")
    want = skewed.withColumns({"rn": F.row_number().over(w), "n": F.count("id").over(Window.partitionBy("g"))})
    got = number_rows(skewed, ["g"], ["v", "id"], size="n")
    rows = lambda df: sorted((r["id"], r["rn"], r["n"]) for r in df.collect())
    assert rows(got) == rows(want)


@pytest.mark.parametrize("window_rows", [0, 500, 200_000])
@pytest.mark.parametrize("tiles", [1, 4, 7, 500])
def test_ntile_equals_window(skewed, tiles, window_rows):
    w = Window.partitionBy("g").orderBy("v", "id")
    want = skewed.withColumn("t", F.ntile(tiles).over(w))
    got = add_ntile(skewed, ["g"], ["v", "id"], tiles, "t", window_rows=window_rows)
    rows = lambda df: sorted((r["id"], r["t"]) for r in df.collect())
    assert rows(got) == rows(want)


@pytest.mark.parametrize("window_rows", [0, 200_000])
def test_ungrouped_ntile(skewed, window_rows):
    counts = {r["t"]: r["count"] for r in add_ntile(skewed, [], ["v", "id"], 7, "t", window_rows=window_rows).groupBy("t").count().collect()}
    assert counts == {1: 429, 2: 429, 3: 429, 4: 429, 5: 428, 6: 428, 7: 428}


@pytest.mark.parametrize("pairs", [0, 200_000])
def test_quantiles_equal_numpy(skewed, pairs):
    probs = [0.0, 0.05, 0.31, 0.5, 0.99, 1.0]
    df = skewed.withColumn("v", F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise(F.col("v") / 3))
    got = {r["g"]: r["qs"] for r in quantiles(df, ["g"], "v", probs, value_pairs=pairs).collect()}
    pdf = df.toPandas()
    for g, rows in pdf.groupby("g", dropna=False):
        key = None if g != g or g is None else g
        np.testing.assert_allclose(got[key], np.quantile(rows["v"].dropna(), probs), atol=1e-12)


def test_quantiles_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([("a", 2.5), ("b", None)], "g string, v double")
    assert [tuple(r) for r in quantiles(one, ["g"], "v", [0.1, 0.9], value_pairs=0).collect()] == [("a", [2.5, 2.5])]
