"""Grouped fits against numpy, searches, routed scoring, splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecastops.operators import scoring as sc
from forecastops.operators import split as sp
from forecastops.operators import training as tr


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(50, 10, (n, 3))
    seg = np.where(np.arange(n) % 3 != 0, "hot", np.where(np.arange(n) % 2 == 0, "a", "b"))
    y = 5 + x @ np.array([1.0, -2.0, 0.5]) + (seg == "hot") * 3 * x[:, 0] + rng.normal(0, 1, n)
    rows = [(i, str(s), 200001 + i % 40, *map(float, r), float(t)) for i, (s, r, t) in enumerate(zip(seg, x, y))]
    return spark.createDataFrame(rows, "id int, seg string, week int, x0 double, x1 double, x2 double, y double")


FEATURES = ["x0", "x1", "x2"]


def test_grouped_fit_equals_least_squares(data):
    pdf = data.toPandas()
    for r in tr.grouped_fit(data, "seg", FEATURES, "y").collect():
        part = pdf[pdf.seg == r["seg"]]
        a = np.column_stack([np.ones(len(part)), part[FEATURES]])
        beta, *_ = np.linalg.lstsq(a, part.y, rcond=None)
        np.testing.assert_allclose([r["intercept"], *r["coefficients"]], beta, rtol=1e-6)
        assert r["train_rmse"] == pytest.approx(np.sqrt(np.mean((part.y - a @ beta) ** 2)), rel=1e-5)


def test_collinear_features_still_predict(data):
    wide = data.withColumn("x3", F.col("x0") + F.col("x1"))
    fit = tr.grouped_fit(wide, "seg", [*FEATURES, "x3"], "y")
    plain = tr.grouped_fit(data, "seg", FEATURES, "y")
    a = {r["id"]: r["prediction"] for r in sc.partitioned_score(wide, fit, "seg", [*FEATURES, "x3"]).collect()}
    b = {r["id"]: r["prediction"] for r in sc.partitioned_score(data, plain, "seg", FEATURES).collect()}
    assert all(a[i] == pytest.approx(b[i], abs=1e-4) for i in a)


def test_trial_errors_equal_refits(data):
    rows = sp.random_split(data, ["id"])
    pdf = rows.toPandas()
    trials = tr.draw_trials(FEATURES, 4, seed=1)
    for r in tr.trial_search(rows, "seg", FEATURES, "y", trials).collect():
        t = trials[r["trial"]]
        cols = [FEATURES[i] for i in t["features"]]
        part = pdf[pdf.seg == r["seg"]]
        fit, val = part[~part.is_test], part[part.is_test]
        mx, my = fit[cols].mean(), fit.y.mean()
        xc = (fit[cols] - mx).to_numpy()
        beta = np.linalg.solve(xc.T @ xc + t["ridge"] * np.eye(len(cols)), xc.T @ (fit.y - my))
        err = val.y - my - (val[cols] - mx).to_numpy() @ beta
        assert r["val_rmse"] == pytest.approx(np.sqrt(np.mean(err**2)), rel=1e-4)


def test_small_segments_are_left_out(data):
    rows = sp.random_split(data.where("seg = 'hot' or id < 60"), ["id"])
    assert {r["seg"] for r in tr.trial_search(rows, "seg", FEATURES, "y", tr.draw_trials(FEATURES, 2)).collect()} == {"hot"}


def test_unknown_segment(data):
    fit = tr.grouped_fit(data.where("seg <> 'b'"), "seg", FEATURES, "y")
    with pytest.raises(Exception, match="no model for segment b"):
        sc.partitioned_score(data, fit, "seg", FEATURES).collect()
    kept = sc.partitioned_score(data, fit, "seg", FEATURES, unknown="null")
    assert kept.where("prediction is null").count() == data.where("seg = 'b'").count()
    with pytest.raises(ValueError, match="missing columns"):
        sc.partitioned_score(data.drop("x1"), fit, "seg", FEATURES)


def test_routed_score_equals_column_score(data):
    fit = {r["seg"]: (r["intercept"], r["coefficients"]) for r in tr.grouped_fit(data, "seg", FEATURES, "y").collect()}
    models = {s: (lambda x, i=i, c=c: i + x @ np.array(c)) for s, (i, c) in fit.items()}
    routed = {r["id"]: r["prediction"] for r in sc.routed_score(data, "seg", models, FEATURES, ["id"]).collect()}
    direct = {r["id"]: r["prediction"] for r in sc.partitioned_score(data, tr.grouped_fit(data, "seg", FEATURES, "y"), "seg", FEATURES).collect()}
    assert routed.keys() == direct.keys() and all(routed[i] == pytest.approx(direct[i]) for i in direct)
    assert sc.routed_score(data.limit(0), "seg", models, FEATURES, ["id"]).count() == 0
    with pytest.raises(Exception, match="no model for segment"):
        sc.routed_score(data, "seg", {"hot": models["hot"]}, FEATURES, ["id"]).collect()


def test_trees(data):
    models = tr.fit_trees(data, "seg", ["hot", "a"], FEATURES, "y", maxIter=5, maxDepth=3)
    # rows of a segment without model raise, or stay without prediction (test_no_lost_rows)
    out = tr.score_trees(data.where("seg <> 'b'"), "seg", models, FEATURES)
    assert out.count() == data.where("seg <> 'b'").count()
    best = tr.best_candidate(tr.candidate_metrics(out, "seg", "y", {"tree": "prediction", "zero": F.lit(0.0)}), "seg")
    assert {r["candidate"] for r in best.collect()} == {"tree"}


@pytest.mark.parametrize("test", [0.2, 0.5, 0.01])
def test_temporal_split_equals_sorted_cut(data, test):
    pdf = data.toPandas().sort_values(["week", "id"])
    want = set()
    for _, part in pdf.groupby("seg"):
        want |= set(part.id.iloc[int(np.floor(len(part) * (1 - test))) :])
    got = {r["id"] for r in sp.temporal_split(data, "seg", "week", ["id"], test).where("is_test").collect()}
    assert got == want
    whole = sp.temporal_split(data, "seg", "week", ["id"], test, by="week")
    assert whole.count() == data.count()
    assert whole.groupBy("seg", "week").agg(F.countDistinct("is_test").alias("n")).where("n > 1").isEmpty()


def test_train_and_holdout_partition_the_cleaned_rows(data):
    train, holdout = sp.clean_and_holdout(data, "seg", "week", ["id"], "y")
    cleaned = sp.clean(data, ["id", "week"], "y")
    ids = lambda df: {r["id"] for r in df.select("id").collect()}
    assert ids(train) | ids(holdout) == ids(cleaned) and not ids(train) & ids(holdout)
    assert cleaned.where("y < 0").isEmpty()
