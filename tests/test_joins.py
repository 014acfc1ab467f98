"""As-of join against brute force; replication over a list."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from forecastops.operators.joins import asof_join, for_each_of


@pytest.fixture(params=["one", "many"])
def partitions(spark, request):
    """All rows in a partition or two, or in as many as there are, with a few rows a batch."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.shuffle.partitions": "13"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items() if request.param == "many" else ():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def test_asof_equals_brute_force(spark, partitions):
    rng = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(minutes=rng.randrange(0, 5 * 24 * 60, 30))
    # entity "hot" has most rows on both sides; times collide on purpose
    who = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", None])
    feats = [(who(), at(), rng.randrange(1000)) for _ in range(400)]
    spine = [(i, who(), at()) for i in range(500)] + [(500, "nobody", at()), (501, "hot", None)]
    f = spark.createDataFrame(feats, "k string, fts timestamp, v int")
    s = spark.createDataFrame(spine, "id int, k string, ts timestamp")
    got = {r["id"]: (r["fts"], r["v"]) for r in asof_join(s, f, ["k"], "ts", "fts").collect()}
    assert len(got) == len(spine)
    for i, k, ts in spine:
        known = [(t, v) for kk, t, v in feats if k is not None and kk == k and ts is not None and t <= ts]
        assert got[i] == (max(known) if known else (None, None)), (i, k, ts)


def test_asof_of_one_hot_entity_and_two_keys(spark, partitions):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    # one early feature, then nothing for many partitions of questions
    s = spark.createDataFrame([(i, "hot", 1, at(i)) for i in range(300)] + [(900 + i, "hot", 2, at(i)) for i in range(40)], "id int, k string, n int, ts timestamp")
    f = spark.createDataFrame([("hot", 1, at(3), 7), ("hot", 1, at(3), 5), ("hot", 0, at(1), 1), ("hot", 2, at(100), 9)], "k string, n int, fts timestamp, v int")
    got = {r.id: r.v for r in asof_join(s, f, ["k", "n"], "ts", "fts").collect()}
    assert got == {**{i: 7 if i >= 3 else None for i in range(300)}, **{900 + i: None for i in range(40)}}
    low = {r.id: r.v for r in asof_join(s, f.withColumn("w", -F.col("v")), ["k", "n"], "ts", "fts", tie_break=["w"]).collect()}
    assert low[10] == 5


def test_asof_of_empty_sides(spark):
    s = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 2))], "id int, k string, ts timestamp")
    f = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 5)], "k string, fts timestamp, v int")
    assert [tuple(r) for r in asof_join(s, f.limit(0), ["k"], "ts", "fts").collect()] == [(1, "a", dt.datetime(2024, 1, 2), None, None)]
    assert asof_join(s.limit(0), f, ["k"], "ts", "fts").collect() == []


def test_duplicate_spine_rows_stay(spark):
    s = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 2))] * 3, "id int, k string, ts timestamp")
    f = spark.createDataFrame([("a", dt.datetime(2024, 1, 2), 5)], "k string, fts timestamp, v int")
    assert [r["v"] for r in asof_join(s, f, ["k"], "ts", "fts").collect()] == [5, 5, 5]


def test_for_each_of(spark):
    rows = spark.range(3)
    values = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "m string")
    assert for_each_of(rows, values, "m").groupBy("m").agg(F.count("id").alias("n")).orderBy("m").collect() == [("x", 3), ("y", 3)]
