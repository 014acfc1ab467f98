"""Hand-computed cases and properties of metrics, drift measures and alerts."""

import math

import pytest
from pyspark.sql import functions as F

from forecastops.functions import metrics as m
from forecastops.operators import alerts as al
from forecastops.operators import drift as dr
from forecastops.operators import histograms as hi
from forecastops.operators import performance as pf

INF, NAN = float("inf"), float("nan")


def _shares(spark, rows):
    return spark.createDataFrame(rows, "week int, seg string, bin_prop double")


def _psi(spark, base, prod, **kw):
    b = _shares(spark, [(1, s, p) for s, p in base.items()])
    q = _shares(spark, [(2, s, p) for s, p in prod.items()])
    return dr.psi(q, b, "seg", ["week"], **kw).first()


def test_psi_cases(spark):
    assert _psi(spark, {"A": 0.5, "B": 0.5}, {"A": 0.5, "B": 0.5})["psi"] == pytest.approx(0, abs=1e-12)
    critical = _psi(spark, {"A": 0.5, "B": 0.5}, {"A": 0.9, "B": 0.1})
    assert (round(critical["psi"], 4), critical["alert_level"]) == (0.8789, 2)


def test_psi_one_sided_segments(spark):
    base, prod = {"A": 0.5, "B": 0.5}, {"A": 0.5, "C": 0.5}
    assert _psi(spark, base, prod)["psi"] == pytest.approx(0, abs=1e-12)
    want = 2 * (0.5 - 1e-10) * math.log(0.5 / 1e-10)
    assert _psi(spark, base, prod, missing="zero")["psi"] == pytest.approx(want)


def _hist(spark, rows):
    return spark.createDataFrame(rows, "week int, seg string, bin int, bin_count long")


def test_js_distance_limits_and_empty_cells(spark):
    base = _hist(spark, [(1, "s", 1, 10), (1, "s", 2, 0), (1, "e", 1, 0), (1, "e", 2, 0)])
    same = dr.js_distance(_hist(spark, [(2, "s", 1, 7), (2, "s", 2, 0)]), base, ["week"], ["seg"]).first()
    assert same["js_distance"] == pytest.approx(0, abs=1e-9)
    apart = dr.js_distance(_hist(spark, [(2, "s", 1, 0), (2, "s", 2, 3)]), base, ["week"], ["seg"]).first()
    assert apart["js_distance"] == pytest.approx(math.sqrt(math.log(2)), abs=1e-6) and apart["alert_level"] == 2
    # a segment without rows that week: share 0 everywhere, no division error, its week stays known
    empty = dr.js_distance(_hist(spark, [(2, "e", 1, 0), (2, "e", 2, 0)]), base, ["week"], ["seg"]).first()
    assert (empty["week"], empty["js_distance"]) == (2, pytest.approx(0, abs=1e-9))


def test_js_distance_is_symmetric(spark):
    a, b = [(1, "s", 1, 3), (1, "s", 2, 7), (1, "s", 3, 1)], [(1, "s", 1, 5), (1, "s", 2, 1), (1, "s", 3, 9)]
    d = lambda x, y: dr.js_distance(_hist(spark, x), _hist(spark, y), ["week"], ["seg"]).first()["js_distance"]
    assert d(a, b) == pytest.approx(d(b, a))


def test_bins_of_duplicate_edges_and_special_values(spark):
    edges = [1.0, 2.0, 2.0, 3.0]
    values = [-INF, 0.0, 1.0, 1.5, 2.0, 2.5, 3.0, 99.0, INF, NAN, None]
    df = spark.createDataFrame([(v, edges) for v in values], "v double, e array<double>")
    got = [r["b"] for r in df.select(hi.bin_of(F.col("v"), F.col("e")).alias("b")).collect()]
    bounds = list(zip([-INF, *edges], [*edges, INF]))
    want = [next((i + 1 for i, (lo, up) in enumerate(bounds) if v is not None and lo <= v < up), None) for v in values]
    assert got == want


def test_histogram_has_every_week_and_bin(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 5.0), (2, "a", 2.0), (2, "b", NAN), (2, "b", None)], "week int, seg string, x double")
    edges = hi.low_edges(rows, "seg", ["x"])
    assert [tuple(r) for r in edges.collect()] == [("a", "x", [1.5])]  # constant in b: no edge
    hist = hi.histogram(rows, ["week"], "seg", ["x"], edges)
    got = sorted((r["week"], r["seg"], r["bin"], r["bin_count"]) for r in hist.collect())
    assert got == [(1, "a", 1, 1), (1, "a", 2, 1), (2, "a", 1, 0), (2, "a", 2, 1)]


def test_bins_round_trip(spark):
    e = spark.createDataFrame([("a", "x", [1.0, 1.0, 2.0])], "seg string, feature string, edges array<double>")
    assert hi.bins_to_edges(hi.edges_to_bins(e, "seg"), "seg").collect() == e.collect()


def test_monitored_columns(spark):
    df = spark.range(500).select(
        F.col("id"), (F.col("id") % 2).alias("flag"), (F.col("id") % 19).alias("few"), (F.col("id") % 20).alias("many"),
        F.lit(1.5).alias("one"), F.lit("t").alias("text"), F.col("id").cast("double").alias("wide"),
    )
    assert hi.monitored_columns(df, ["ID"]) == {"low": ["few"], "high": ["many", "wide"]}


def _metric(spark, rows, *cols):
    df = spark.createDataFrame(rows, "y double, p double")
    return df.agg(*[c.alias(n) for n, c in m.error_sums("y", "p").items()]).select(*cols).first()


def test_metric_formulas(spark):
    rows = [(10.0, 8.0), (0.0, 3.0), (5.0, 0.0), (0.0, 0.0), (4.0, 4.0)]
    got = _metric(spark, rows, *[c.alias(n) for n, c in m.monitored().items()], *[m.mape(z).alias(z) for z in ("skip", "mask", "one")])
    assert got["wape"] == pytest.approx(10 / 19)
    assert got["rmse"] == pytest.approx(math.sqrt(38 / 5))
    assert got["mae"] == pytest.approx(2)
    assert got["f1_binary"] == pytest.approx(2 * 2 / (2 * 2 + 1 + 1))
    assert got["skip"] == got["mask"] == pytest.approx(100 * (0.2 + 1 + 0) / 3)
    assert got["one"] == pytest.approx(100 * (0.2 + 3 + 1 + 0 + 0) / 5)


def test_f1_without_positive_forecast_and_zero_actuals(spark):
    got = _metric(spark, [(1.0, 0.0), (0.0, 0.0)], m.f1_binary().alias("f"))
    assert got["f"] == 0
    assert _metric(spark, [(0.0, 2.0)], m.wape().alias("w"))["w"] == pytest.approx(2 / 1e-10)


def test_rollup_repeats_the_whole_model_per_dimension(spark):
    rows = spark.createDataFrame([(1, "v", "a", "x", 1.0, 2.0), (1, "v", "b", "x", 3.0, 3.0)], "week int, model_version string, s string, c string, y double, p double")
    out = pf.metric_rollup(rows, ["s", "c"], "y", "p").where("metric_col = 'mae'")
    got = {(r["aggregated_col"], r["aggregated_value"]): r["metric_value"] for r in out.collect()}
    assert got == {("s", "a"): 1.0, ("s", "b"): 0.0, ("s", "full_model"): 0.5, ("c", "x"): 0.5, ("c", "full_model"): 0.5}


def _cells(spark, rows):
    return spark.createDataFrame([(1, "v", "s", "a", k, v) for k, v in rows], "week int, model_version string, aggregated_col string, aggregated_value string, metric_col string, metric_value double")


def test_relative_alert(spark):
    base = pf.metric_baseline(_cells(spark, [("wape", 0.10), ("f1_binary", 0.8), ("mae", 1.0)]))
    now = _cells(spark, [("wape", 0.13), ("f1_binary", 0.5), ("mae", 1.1), ("rmse", 9.0)])
    got = {r["metric_col"]: (r["metric_drift"], r["alert_level"]) for r in al.relative_alert(now, base).collect()}
    assert got["wape"] == (pytest.approx(0.3), 1) and got["f1_binary"] == (pytest.approx(-0.375), 2)
    assert got["mae"][1] == 0 and got["rmse"] == (None, 0)


@pytest.mark.parametrize("value,level", [(0.219, 0), (0.225, 1), (0.231, 2)])
def test_sigma_alert(spark, value, level):
    # mean 0.2, sample standard deviation 0.01
    cells = spark.createDataFrame([(w, "v", "s", "a", "wape", v) for w, v in ((1, 0.19), (2, 0.2), (3, 0.21))], _cells(spark, [("wape", 0.0)]).schema)
    weeks = cells.select("model_version", "week")
    got = al.sigma_alert(_cells(spark, [("wape", value)]), cells, weeks).first()
    assert (got["alert_level"], round(got["warning_threshold"], 6), round(got["critical_threshold"], 6)) == (level, 0.22, 0.23)


def test_sigma_alert_without_and_with_one_week(spark):
    one = _cells(spark, [("wape", 0.2), ("f1_binary", 0.8)])
    now = _cells(spark, [("wape", 0.2001), ("f1_binary", 0.81), ("mae", 1.0)])
    weeks = one.select("model_version", "week")
    got = {r["metric_col"]: r["alert_level"] for r in al.sigma_alert(now, one, weeks).collect()}
    assert got == {"wape": 2, "f1_binary": 0, "mae": -1}
    assert {r["alert_level"] for r in al.sigma_alert(now, one, weeks, min_weeks=2).collect()} == {-1}


def test_rollback_decision(spark):
    rows = [("ok", 5000, 0.05, 0.02, 0.05), ("psi", 5000, 0.25, 0.02, 0.05), ("kl", 5000, 0.05, 0.15, 0.05), ("rmse", 5000, 0.05, 0.02, 0.35), ("few", 500, 0.25, 0.15, 0.35), ("all", 1000, 0.3, 0.2, 0.5)]
    df = spark.createDataFrame(rows, "m string, sample_count long, psi double, kl double, rmse_increase double")
    got = {r["m"]: (r["action"], r["reason"]) for r in al.rollback_decision(df).collect()}
    assert got["ok"] == ("none", "All metrics within thresholds")
    assert got["psi"] == ("rollback", "data_drift_psi=0.25 > 0.2")
    assert got["kl"] == ("rollback", "prediction_drift_kl=0.150 > 0.1")
    assert got["rmse"] == ("rollback", "rmse_increase=35% > 25%")
    assert got["few"] == ("skip", "Insufficient samples (500)")
    assert got["all"][1].count("; ") == 2


def test_orphan_sales_count_against_every_model(spark):
    fc = spark.createDataFrame([(1, "m1", 5.0), (1, "m2", 6.0), (2, "m1", 1.0)], "k int, model_uri string, prediction double")
    sales = spark.createDataFrame([(1, 4.0), (3, 9.0)], "k int, actual double")
    got = sorted(tuple(r) for r in pf.forecast_vs_sales(fc, sales, ["k"]).select("k", "model_uri", "actual", "prediction").collect())
    assert got == [(1, "m1", 4.0, 5.0), (1, "m2", 4.0, 6.0), (2, "m1", 0.0, 1.0), (3, "m1", 9.0, 0.0), (3, "m2", 9.0, 0.0)]


def test_chi_square(spark):
    ref = spark.createDataFrame([("f", "a", 30), ("f", "b", 10)], "feature string, bin string, bin_count long")
    ana = spark.createDataFrame([("f", "a", 10), ("f", "b", 30)], "feature string, bin string, bin_count long")
    got = dr.chi_square(ref, ana, ["feature"]).first()
    assert (got["chi_square"], got["cramers_v"]) == (pytest.approx(20.0), pytest.approx(0.5))
