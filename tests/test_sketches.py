"""Stored sketches and two-sample tests against exact figures."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecastops.operators import samples as sa
from forecastops.operators import sketches as sk

PROBS = [0.05, 0.25, 0.5, 0.9, 0.99]


def sales(spark, weeks, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(w), str(s) if s < 2 else None, float(v), float(i % 3), int(e)) for w in weeks for i, (s, v, e) in enumerate(zip(rng.integers(0, 3, n), rng.lognormal(size=n), rng.integers(0, 500, n)))]
    rows += [(weeks[0], "0", None, 1.0, None), (weeks[0], "0", float("nan"), 1.0, 1)]
    return spark.createDataFrame(rows, "week int, seg string, v double, c double, who int")


def test_quantiles_of_merged_weeks(spark, folder):
    rows = sales(spark, [1, 2, 3]).cache()
    make = lambda part: sk.quantile_sketches(part, "week", "seg", ["v", "c"])
    assert sk.add_weeks(spark, f"{folder}/q", rows.where("week < 3"), "week", make) == [1, 2]
    files = lambda w: {e.name for e in os.scandir(f"{folder}/q/week={w}")}
    before = files(1) | files(2)
    # the second run adds week 3 and leaves the others, also where more rows have come for them
    assert sk.add_weeks(spark, f"{folder}/q", rows.unionByName(rows.where("week = 1")), "week", make) == [3]
    assert files(1) | files(2) == before
    assert sk.add_weeks(spark, f"{folder}/q", rows, "week", make) == []
    stored = spark.read.parquet(f"{folder}/q")
    pdf = rows.toPandas()
    got = {(r.seg, r.feature): r for r in sk.sketched_quantiles(stored, ["seg", "feature"], PROBS).collect()}
    assert len(got) == 6
    for (seg, feature), r in got.items():
        mine = pdf[pdf.seg.isna() if seg is None else pdf.seg == seg][feature].dropna().to_numpy()
        assert r.n == len(mine) and (r.low, r.high) == (mine.min(), mine.max())
        for p, q in zip(PROBS, r.qs):
            assert (mine < q).mean() - sk.RANK_ERROR <= p <= (mine <= q).mean() + sk.RANK_ERROR
    one_week = {r.seg: r.n for r in sk.sketched_quantiles(stored.where("week = 3 and feature = 'v'"), ["seg"], PROBS).collect()}
    assert sum(one_week.values()) == 3000
    edges = sk.sketched_edges(stored, "seg", 4).collect()
    assert all(r.edges == sorted(set(r.edges)) and len(r.edges) <= 3 for r in edges)


def test_constant_features_have_no_edges(spark):
    rows = spark.createDataFrame([(1, "a", 2.0, float(i)) for i in range(9)], "week int, seg string, k double, v double")
    found = sk.sketched_edges(sk.quantile_sketches(rows, "week", "seg", ["k", "v"]), "seg", 2).collect()
    assert [(r.feature, r.n) for r in found] == [("v", 9)]


def test_distinct_counts_add_up(spark, folder):
    rows = sales(spark, [1, 2, 3]).cache()
    make = lambda part: sk.distinct_sketches(part, "week", "seg", "who")
    sk.add_weeks(spark, f"{folder}/d", rows, "week", make)
    found = sk.distinct_levels(spark.read.parquet(f"{folder}/d"), [["seg", "week"], ["seg"], []]).collect()
    pdf = rows.toPandas()
    assert len(found) == 9 + 3 + 1
    for r in found:
        mine = pdf
        if r.level < 2:
            mine = mine[mine.seg.isna() if r.seg is None else mine.seg == r.seg]
        if r.level < 1:
            mine = mine[mine.week == r.week]
        assert (r.n_rows, r.n_distinct) == (mine.who.notna().sum(), mine.who.nunique())


def test_large_distinct_counts_are_near(spark):
    rows = spark.range(200_000).select((F.col("id") % 4).alias("week"), F.lit("s").alias("seg"), (F.col("id") % 100_000).alias("who"))
    total = sk.distinct_levels(sk.distinct_sketches(rows, "week", "seg", "who"), [["seg", "week"], []]).where("level = 2").first()
    assert abs(total.n_distinct - 100_000) < 4_000


def exact(a, b):
    a, b = np.sort(a), np.sort(b)
    at = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(a, at, side="right") / len(a) - np.searchsorted(b, at, side="right") / len(b))
    return gap.max(), float((gap[:-1] * np.diff(at)).sum())


def test_two_samples(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g, shift in (("a", 0.0), ("b", 0.7), (None, 2.0)):
        for is_a in (True, False):
            n = int(rng.integers(200, 900))
            values = np.where(rng.random(n) < 0.4, 3.0, np.round(rng.normal(size=n) + (0 if is_a else shift), 1))
            rows += [(g, float(v), is_a) for v in values]
    rows += [("a", None, True), ("a", float("nan"), False), ("a", 1.0, None), ("one", 5.0, True), ("one", 6.0, True)]
    rows += [("same", float(i % 5), i < 50) for i in range(100)]
    found = {r.g: r for r in sa.two_sample(spark.createDataFrame(rows, "g string, v double, a boolean").repartition(6), ["g"], "v", F.col("a")).collect()}
    assert found["one"].ks is None and found["one"].p_value is None and (found["one"].n_a, found["one"].n_b) == (2, 0)
    assert (found["same"].ks, found["same"].wasserstein, found["same"].p_value) == (0.0, 0.0, 1.0)
    for g in ("a", "b", None):
        part = lambda is_a: np.array([v for h, v, a in rows if h == g and a is is_a and v is not None and v == v])  # noqa: E731,B023
        ks, w = exact(part(True), part(False))
        assert math.isclose(found[g].ks, ks, abs_tol=1e-12) and math.isclose(found[g].wasserstein, w, abs_tol=1e-9)
        assert (found[g].n_a, found[g].n_b) == (len(part(True)), len(part(False)))
    assert found["a"].p_value > 0.01 > found["b"].p_value > found[None].p_value


@pytest.mark.parametrize("n, d, p", [(100, 0.1, 0.6797), (100, 0.2, 0.0328), (1000, 0.05, 0.1585)])
def test_p_value(spark, n, d, p):
    got = spark.range(1).select(sa._p_value(F.lit(d), F.lit(float(n)), F.lit(float(n)))).first()[0]
    x = d * (math.sqrt(n / 2) + 0.12 + 0.11 / math.sqrt(n / 2))
    assert math.isclose(got, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101)), abs_tol=1e-12)
    assert abs(got - p) < 0.02


def test_empty(spark):
    none = spark.createDataFrame([], "g string, v double, a boolean")
    assert sa.two_sample(none, ["g"], "v", F.col("a")).collect() == []
