"""Boosted trees and successive halving against plain Python."""

import math
import random

import numpy as np
import pytest

from forecastops.operators import boosting as bo
from forecastops.operators import halving as ha
from forecastops.operators.training import draw_trials, trial_search

EDGES = [[0.0, 1.0, 2.0, 5.0], [-1.0, 0.5]]


def rows_of(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        seg = rng.choice(["a", "a", "a", "b", None])
        x1, x2 = rng.choice([None, rng.uniform(-1, 7)]), rng.uniform(-3, 3)
        y = None if i % 50 == 0 else round((x1 or 0) * (2 if seg == "a" else -1) + (x2 > 0.5) * 3 + rng.gauss(0, 1), 3)
        out.append((i, seg, x1, x2, y))
    return out


def grown(rows, rounds, depth, rate, penalty, least):
    """Predictions by seg and row, trees grown one node at a time."""
    bins = lambda r: [0 if r[k] is None else sum(e < r[k] for e in EDGES[k - 2]) for k in (2, 3)]
    out = {}
    for seg in {r[1] for r in rows}:
        every = [r for r in rows if r[1] == seg]
        known = [r for r in every if r[4] is not None]
        base = sum(r[4] for r in known) / len(known)
        pred = {r[0]: base for r in every}
        for _ in range(rounds):
            g = {r[0]: round((r[4] - pred[r[0]]) / bo.UNIT) for r in known}
            value, todo = {}, [(known, every, 0, 0.0)]
            while todo:
                fit, reach, level, leaf = todo.pop()
                value.update({r[0]: leaf for r in reach})
                if level == depth:
                    continue
                part = lambda rs: sum(g[r[0]] for r in rs) ** 2 / (len(rs) + penalty)
                best = None
                for f in (0, 1):
                    for b in range(len(EDGES[f])):
                        lo = [r for r in fit if bins(r)[f] <= b]
                        hi = [r for r in fit if bins(r)[f] > b]
                        if min(len(lo), len(hi)) >= max(least, 1):
                            gain = part(lo) + part(hi) - part(fit)
                            if gain > 0 and (best is None or gain > best[0] * (1 + 1e-12)):
                                best = (gain, f, b, lo, hi)
                if best:
                    _, f, b, lo, hi = best
                    for fitted, left in ((lo, True), (hi, False)):
                        mine = [r for r in reach if (bins(r)[f] <= b) == left]
                        todo.append((fitted, mine, level + 1, rate * sum(g[r[0]] for r in fitted) * bo.UNIT / (len(fitted) + penalty)))
            pred = {i: p + value[i] for i, p in pred.items()}
        out.update(pred)
    return out


SCHEMA = "id int, seg string, x1 double, x2 double, y double"


@pytest.mark.parametrize("rounds, depth, keep_every", [(1, 1, 10), (3, 3, 10), (5, 2, 2)])
def test_trees_equal_plain_python(spark, rounds, depth, keep_every):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = bo.fit_boosted(df, "seg", ["x1", "x2"], "y", EDGES, rounds=rounds, depth=depth, rate=0.3, min_rows=4, keep_every=keep_every)
    assert sorted((r.seg or "", r.n_rows, len(r.trees)) for r in model.collect()) == sorted((s or "", sum(r[1] == s and r[4] is not None for r in rows), rounds) for s in ("a", "b", None))
    got = {r.id: r.p for r in bo.predict_boosted(df, "seg", ["x1", "x2"], model, "p").collect()}
    want = grown(rows, rounds, depth, 0.3, 1.0, 4)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], abs_tol=1e-5) for i in want)


def test_order_of_rows_does_not_matter(spark):
    df = spark.createDataFrame(rows_of(200, 3), SCHEMA)
    fit = lambda d: sorted(map(str, bo.splits(bo.fit_boosted(d, "seg", ["x1", "x2"], "y", EDGES, rounds=2, depth=2), "seg", ["x1", "x2"]).collect()))
    assert fit(df.repartition(1)) == fit(df.repartition(7))


def test_unknown_segments_and_empty_tables(spark):
    df = spark.createDataFrame(rows_of(100), SCHEMA)
    model = bo.fit_boosted(df.where("seg = 'a'"), "seg", ["x1"], "y", EDGES[:1], rounds=1, depth=1)
    scored = bo.predict_boosted(df, "seg", ["x1"], model, "p")
    assert scored.count() == 100 and scored.where("(coalesce(seg, '') = 'a') = (p is null)").count() == 0
    empty = bo.fit_boosted(df.limit(0), "seg", ["x1"], "y", EDGES[:1], rounds=1, depth=2)
    assert empty.collect() == [] and bo.predict_boosted(df, "seg", ["x1"], empty, "p").where("p is not null").count() == 0


def test_scans_do_not_grow_with_segments(spark):
    """Jobs of a fit: the same for three segments and for thirty."""
    context = spark.sparkContext

    def jobs(segments):
        rows = [(i, f"s{i % segments}", float(i % 7), float(i % 5), float(i % 11)) for i in range(600)]
        df = spark.createDataFrame(rows, SCHEMA)
        context.setJobGroup(f"fit{segments}", "fit")
        bo.fit_boosted(df, "seg", ["x1", "x2"], "y", EDGES, rounds=2, depth=2).collect()
        found = context.statusTracker().getJobIdsForGroup(f"fit{segments}")
        context.setJobGroup("", "")
        return len(found)

    assert jobs(30) <= jobs(3) + 2


def test_quantile_edges(spark):
    df = spark.createDataFrame([(float(v), None) for v in [1, 1, 1, 1, 2, 3, 4, 5, 9]], "x double, n double")
    assert bo.quantile_edges(df, ["x", "n"], 4, exact=True) == [[1.0, 2.0, 4.0], []]


def halving_rows(seed=5):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(900):
        seg = ["a", "b", None][i % 3]
        x = rng.normal(size=3)
        out.append((i, seg, *map(float, x), float(x[0] * 2 - x[1] + rng.normal()), bool(rng.random() < 0.3)))
    return out


def test_halving_keeps_the_best_of_each_rung(spark):
    df = spark.createDataFrame(halving_rows(), "id int, seg string, x0 double, x1 double, x2 double, y double, is_test boolean").repartition(3)
    names = ["x0", "x1", "x2"]
    trials = draw_trials(names, 11)
    found = ha.halving_search(df, "seg", names, "y", trials, ["id"], rungs=(20, 50, 100), keep=3).collect()
    full = {(r.seg, r.trial): r.val_rmse for r in trial_search(df, "seg", names, "y", trials).collect()}
    for seg in ("a", "b", None):
        rung = lambda k: sorted((r for r in found if r.seg == seg and r.rung == k), key=lambda r: r.place)  # noqa: E731,B023
        assert [len(rung(k)) for k in range(3)] == [11, 4, 2]
        for k in (0, 1):
            assert {r.trial for r in rung(k) if r.kept} == {r.trial for r in rung(k + 1)}
            assert rung(k)[0].sample_size < rung(k + 1)[0].sample_size
        for r in rung(2):
            if seg is not None:
                assert math.isclose(r.val_rmse, full[seg, r.trial], rel_tol=1e-9)
    best = {r.seg: r for r in ha.halving_best(spark.createDataFrame(found), "seg").collect()}
    assert set(best) == {"a", "b", None} and all(r.rung == 2 for r in best.values())


def test_settled_segments_and_small_samples(spark):
    df = spark.createDataFrame([(i, "s", float(i), float(2 * i), i % 4 == 0) for i in range(40)] + [(99, "tiny", 1.0, 1.0, False)], "id int, seg string, x double, y double, is_test boolean")
    trials = [{"trial": i, "ridge": r} for i, r in enumerate((0.0, 1e6))]
    found = ha.halving_search(df, "seg", ["x"], "y", trials, ["id"], rungs=(50, 100), keep=2).collect()
    assert {(r.seg, r.rung, r.trial) for r in found} == {("s", 0, 0), ("s", 0, 1)}
    assert [r.trial for r in found if r.kept] == [0]
    assert ha.halving_search(df.limit(0), "seg", ["x"], "y", trials, ["id"]).collect() == []
