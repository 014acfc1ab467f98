"""The monitoring jobs end to end on landing datasets."""

from pyspark.sql import functions as F

from forecastops.operators import scoring as sc
from forecastops.operators import training as tr
from forecastops.plans import jobs
from forecastops.plans.frames import baseline, grouped, production
from forecastops.session import cut

SEGS = ["stats_group", "cust_category"]
COLUMNS = ["w_m1_total", "sum_past_4_weeks"]
IDS = ["customer_id", "brand"]


def _run(spark, root, rows, models):
    low, high, one = ["quarter"], ["sum_p4w", "avg_past_12_weeks"], SEGS[:1]
    features = rows.drop("prediction")
    jobs.score(spark, root, features, models, "linear", "stats_group", COLUMNS, IDS, unit="u")
    view = sc.prediction_view(jobs.read(spark, root, "predictions"), {"customer_id": "int", "brand": "string"}, "stats_group")
    view = view.join(rows.select("customer_id", "brand", "week", "cust_category"), ["customer_id", "brand", "week"])
    actuals = rows.select("customer_id", "brand", "week", "y")
    for v in ("v1",):
        jobs.drift_baseline(spark, root, baseline(features), "linear", v, one, low, high)
        jobs.drift_baseline(
            spark, root, baseline(view.where(F.col("model_version") == v)), "linear", v, one, [], ["prediction"], predictions=True
        )
    keys = ["customer_id", "brand", "week"]
    jobs.performance_baseline(spark, root, baseline(view), actuals, "linear", SEGS, "y", keys, unit="u")
    jobs.data_drift(spark, root, production(features), "linear", one, [*low, *high], unit="u", min_week=200001)
    jobs.prediction_drift(spark, root, "linear", one, production(view), unit="u", min_week=200001)
    jobs.performance(spark, root, production(view), actuals, "linear", SEGS, "y", keys, unit="u", min_week=200001)


def _cells(df):
    return {(r["record_id"], r["metric_value"] and round(r["metric_value"], 9)) for r in df.select("record_id", "metric_value").toLocalIterator()}


def test_jobs_cover_all_combos_and_repeat_without_change(spark, sf, folder):
    rows = cut(grouped(spark, sf).where("week > 199944"))
    models = cut(tr.models_frame(spark, tr.grouped_fit(rows, "stats_group", COLUMNS, "y"), "linear", "v1"))
    _run(spark, folder, rows, models)
    tables = ("drift", "prediction_drift", "performance")
    first = {t: _cells(jobs.read(spark, folder, t)) for t in tables}
    counts = {r["dataset"]: r["row_count"] for r in jobs.summary(spark, folder).collect()}
    n = rows.count()
    assert counts["predictions"] == n
    # a week whose segments are all unknown to the baseline has a row without value
    known = baseline(rows).select("stats_group").distinct()
    weeks = production(rows).join(known, "stats_group", "left_semi").select("week").distinct().count()
    psi = jobs.read(spark, folder, "drift").where(F.col("metric_col") == jobs.PSI)
    assert psi.where("metric_value is not null").count() == weeks
    assert psi.count() == production(rows).select("week").distinct().count()
    # bins of every week add up to the week's rows
    hist = jobs.read(spark, folder, "histograms").where("metric_col = 'jensen-shannon' and aggregated_col = 'stats_group' and model_version = 'v1'")
    per_feature = hist.groupBy(F.col("entity_map")["feature_name"].alias("f")).agg(F.sum("metric_map.bin_count").alias("n")).collect()
    monitored = {r["f"]: r["n"] for r in per_feature}
    assert 0 < monitored["sum_p4w"] == production(rows).join(known, "stats_group", "left_semi").count()
    assert all(v for v in first.values())
    _run(spark, folder, rows, models)
    assert {t: _cells(jobs.read(spark, folder, t)) for t in tables} == first
    assert {r["dataset"]: r["row_count"] for r in jobs.summary(spark, folder).collect()} == counts


def test_new_weeks_only_give_the_same_as_all_at_once(spark, sf, folder):
    rows = cut(grouped(spark, sf).where("week > 199946"))
    fits = [tr.models_frame(spark, tr.grouped_fit(rows, "stats_group", COLUMNS, "y", ridge), "linear", v) for ridge, v in ((0.0, "v1"), (1e3, "v2"))]
    models = cut(fits[0].unionByName(fits[1]))
    for name, parts in (("steps", ("week < 200020", "true")), ("once", ("true",))):
        root = f"{folder}/{name}"
        for condition in parts:
            part = rows.where(condition)
            jobs.score(spark, root, part.drop("prediction"), models, "linear", "stats_group", COLUMNS, IDS, unit="u")
            for v in ("v1", "v2"):
                jobs.drift_baseline(spark, root, baseline(part), "linear", v, ["stats_group"], [], ["sum_p4w"], exact=True)
            jobs.data_drift(spark, root, production(part), "linear", ["stats_group"], ["sum_p4w"], unit="u", min_week=200001)
    steps, once = (_cells(jobs.read(spark, f"{folder}/{n}", "drift")) for n in ("steps", "once"))
    assert steps == once and steps
    predictions = jobs.read(spark, f"{folder}/once", "predictions")
    assert {r["model_version"]: r["count"] for r in predictions.groupBy("model_version").count().collect()} == {"v1": rows.count(), "v2": rows.count()}
