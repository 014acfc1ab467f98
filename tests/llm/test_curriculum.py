import numpy as np
import pytest
from pyspark.sql import functions as F

from forecastops.llm import curriculum as c

SCHEMA = "doc_id long, text string, source string, target int, rank string"


def filled(sizes, weights, budget, repeat):
    """Targets by raising a level step by step: the brute-force form of sharing the excess by weight."""
    target, left, free = [0.0] * len(sizes), budget * sum(sizes), set(range(len(sizes)))
    while free and left > 1e-9:
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        full = {i for i in free if target[i] + share[i] >= repeat * sizes[i] - 1e-9}
        for i in full or free:
            add = min(share[i], repeat * sizes[i] - target[i])
            target[i] += add
        left = budget * sum(sizes) - sum(target)
        if not full:
            break
        free -= full
    return target


@pytest.mark.parametrize("sizes", [[10, 1000, 50], [5, 5, 5, 5], [100, 1, 1, 1, 500], [0, 7, 9], [0], [3000, 10, 20, 30, 40, 50, 60]])
def test_targets(spark, sizes):
    rows = [(None if i == len(sizes) - 1 else f"s{i}", float(n)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, size double").withColumn("size", F.col("size").cast("long"))
    got = [r.target for r in c.source_targets(df).orderBy(F.col("source").asc_nulls_last()).collect()]
    assert np.allclose(got, filled(sizes, [3, 1, 2] * len(sizes), 1.5, 2.0))


def test_position_inverts_the_integral(spark):
    for k, knots in enumerate(c.SCHEDULES):
        shares = np.linspace(0, 0.999, 37)
        df = spark.createDataFrame([(float(s), k) for s in shares], "share double, shape int")
        at = [r[0] for r in df.select(c._position(F.col("share"), c.SCHEDULES)).collect()]
        t, w = np.array(knots).T
        grid = np.linspace(0, 1, 20001)
        total = np.concatenate([[0], np.cumsum((np.interp(grid, t, w)[1:] + np.interp(grid, t, w)[:-1]) / 2 * np.diff(grid))])
        assert np.allclose(np.interp(at, grid, total / total[-1]), shares, atol=1e-6)


def test_rows_hold(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 11}", 1, "x") for i in range(3000)]
    rows += [(1, None, None, 1, "x"), (None, "a b", None, 1, "x"), (5, "", "s1", 1, "x"), (7, "w " * 7, "hot", 1, "x"), (9, "long " * 5000, "s1", 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    plan = c.mix(docs).cache()
    assert plan.count() == len(rows)
    assert plan.filter(F.col("taken") > 2 * F.col("size")).count() == 0
    longest = docs.count() and 5000
    off = plan.groupBy("source").agg(F.abs(F.sum("taken") - F.first("target")).alias("off")).agg(F.max("off")).first()[0]
    assert off <= longest / 2 + 1
    again = c.mix(docs.repartition(7))
    assert plan.exceptAll(again).count() == 0
    order = c.training_order(plan).collect()
    assert len(order) == plan.agg(F.sum("passes")).first()[0]
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(0 <= r.position <= 1 for r in order)
    # heavier weights early where the schedule falls, late where it rises
    assert c.mix(docs.limit(0)).collect() == []
    plan.unpersist()


def test_bad_schedule():
    with pytest.raises(ValueError):
        c._segments([(0.0, 1.0)])
