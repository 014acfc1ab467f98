"""Registered queries: histograms, drift, performance, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecastops.functions.calendar import weeks_after
from forecastops.functions.keys import record_id
from forecastops.operators import alerts as al
from forecastops.operators import drift as dr
from forecastops.operators import histograms as hi
from forecastops.operators import performance as pf
from forecastops.operators.features import guarded_lags
from forecastops.operators.ranking import add_ntile
from forecastops.plans.frames import ROW_IDS, SERIES_IDS, baseline, grouped, production, stored_groups, weekly_sales
from forecastops.session import cut, store
from forecastops.plans.registry import BASE, PANEL, SPLIT_WEEK, TX, lag_sql, query, with_

LOW, HIGH = ["quarter"], ["sum_p4w", "avg_past_12_weeks"]
SEG = "stats_group"
PROD = f"prod AS (SELECT * FROM grouped WHERE week >= {SPLIT_WEEK})"
BASELINE = f"base AS (SELECT * FROM grouped WHERE week < {SPLIT_WEEK})"

# --- SQL of the histogram rules, one text per step ---------------------------------------------------------------------

LONG = """long_{t} AS (SELECT * FROM (
  SELECT week, stats_group, UNNEST(['quarter', 'sum_p4w', 'avg_past_12_weeks', 'prediction']) AS feature,
         UNNEST([CAST(quarter AS DOUBLE), sum_p4w, avg_past_12_weeks, prediction]) AS value FROM {t}) WHERE value IS NOT NULL)"""
PROBS = "[" + ", ".join(str(i / 20) for i in range(1, 20)) + "]"
EDGES = f"""low_edge AS (
  SELECT stats_group, feature, (value + LEAD(value) OVER (PARTITION BY stats_group, feature ORDER BY value)) / 2.0 AS edge
  FROM (SELECT DISTINCT stats_group, feature, value FROM long_base WHERE feature = 'quarter')),
low_edges AS (SELECT stats_group, feature, list(edge ORDER BY edge) AS edges FROM low_edge WHERE edge IS NOT NULL GROUP BY 1, 2),
high_edges AS (SELECT stats_group, feature, quantile_cont(value, {PROBS}) AS edges FROM long_base WHERE feature <> 'quarter' GROUP BY 1, 2),
edges AS (SELECT * FROM low_edges UNION ALL SELECT * FROM high_edges),
bins AS (
  SELECT stats_group, feature, i AS bin, CASE WHEN i = 1 THEN CAST('-infinity' AS DOUBLE) ELSE edges[i - 1] END AS bin_low,
         CASE WHEN i = len(edges) + 1 THEN CAST('infinity' AS DOUBLE) ELSE edges[i] END AS bin_high
  FROM (SELECT *, CAST(UNNEST(range(1, len(edges) + 2)) AS INTEGER) AS i FROM edges))"""
HIST = """hits_{t} AS (
  SELECT l.week, l.stats_group, l.feature, b.bin, COUNT(*) AS n FROM long_{t} l JOIN bins b
    ON l.stats_group = b.stats_group AND l.feature = b.feature AND l.value >= b.bin_low AND l.value < b.bin_high
  GROUP BY ALL),
hist_{t} AS (
  SELECT w.week, b.stats_group, b.feature, b.bin, b.bin_low, b.bin_high, COALESCE(h.n, 0) AS bin_count
  FROM (SELECT DISTINCT week FROM {t}) w CROSS JOIN bins b
  LEFT JOIN hits_{t} h ON h.week = w.week AND h.stats_group = b.stats_group AND h.feature = b.feature AND h.bin = b.bin)"""
SHARES = """p_bins AS (
  SELECT stats_group, feature, bin, AVG(pr) AS p FROM (
    SELECT *, bin_count / GREATEST(SUM(bin_count) OVER (PARTITION BY week, stats_group, feature), 1.0) AS pr FROM hist_base) GROUP BY 1, 2, 3),
q_bins AS (
  SELECT week, stats_group, feature, bin, COALESCE(bin_count / NULLIF(SUM(bin_count) OVER (PARTITION BY week, stats_group, feature), 0.0), 0) AS q
  FROM hist_prod),
cells AS (
  SELECT week, stats_group, feature, bin, GREATEST(COALESCE(p, 0), 1e-10) AS p, GREATEST(q, 1e-10) AS q, COALESCE(p, 0) AS p0, q AS q0
  FROM q_bins LEFT JOIN p_bins USING (stats_group, feature, bin))"""
DRIFT = [*BASE, PROD, BASELINE, LONG.format(t="base"), LONG.format(t="prod"), EDGES, HIST.format(t="base"), HIST.format(t="prod"), SHARES]
JSD = "SQRT(0.5 * SUM(p * LN(p / ((p + q) / 2))) + 0.5 * SUM(q * LN(q / ((p + q) / 2))))"


def _edges(spark, sf, low, high):
    base = baseline(stored_groups(spark, sf))
    return hi.bin_edges(base, SEG, low, high, exact=True)


def _histograms(spark, sf, low, high):
    """Baseline and production histograms on the baseline's bins, counted in one pass over the features written once."""
    rows = stored_groups(spark, sf)
    edges = hi.bin_edges(baseline(rows), SEG, low, high, exact=True)
    hist = store(hi.histogram(rows, ["week"], SEG, [*low, *high], edges))
    return baseline(hist), production(hist)


@query("unpivot_features", with_([*BASE, BASELINE, LONG.format(t="base")], "SELECT week, stats_group, feature, COUNT(*) AS n, SUM(value) AS total FROM long_base GROUP BY ALL"), "total")
def unpivot_features(spark, sf):
    """Long form of four features, summed per cell."""
    long = hi.unpivot_features(baseline(grouped(spark, sf)), ["week", SEG], [*LOW, *HIGH, "prediction"])
    return long.groupBy("week", SEG, "feature").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "monitored_columns",
    with_(
        BASE,
        """SELECT feature, class, (SELECT COUNT(*) FROM grouped) AS row_count FROM (
             SELECT 'quarter' AS feature, CASE WHEN COUNT(DISTINCT quarter) < 20 THEN 'low' ELSE 'high' END AS class FROM grouped
             UNION ALL SELECT 'week_of_year', CASE WHEN COUNT(DISTINCT week_of_year) < 20 THEN 'low' ELSE 'high' END FROM grouped
             UNION ALL SELECT 'sum_p4w', CASE WHEN COUNT(DISTINCT sum_p4w) < 20 THEN 'low' ELSE 'high' END FROM grouped)""",
    ),
)
def monitored_columns(spark, sf):
    """Columns to monitor, with their class: flags and constants are left out."""
    rows = grouped(spark, sf).withColumns({"is_value": (F.col("cust_category") == "VALUE").cast("int"), "one": F.lit(1)})
    kept = rows.select(*ROW_IDS, "is_value", "one", "quarter", "week_of_year", "sum_p4w")
    classes = hi.monitored_columns(kept, ["CUSTOMER_ID", "week"])
    listed = [F.struct(F.lit(c).alias("feature"), F.lit(k).alias("class")) for k, cs in classes.items() for c in cs]
    count = rows.agg(F.count(F.lit(1)).alias("row_count"))
    return count.select(F.explode(F.array(*listed)).alias("c"), "row_count").select("c.*", "row_count")


@query("segment_proportions", with_(BASE, "SELECT week, stats_group, COUNT(*) AS bin_count, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY week) AS bin_prop FROM grouped GROUP BY 1, 2"), "bin_prop")
def segment_proportions(spark, sf):
    return hi.proportions(grouped(spark, sf), ["week"], SEG)


INNER = "SELECT stats_group, feature, bin, bin_low FROM bins WHERE bin > 1"


@query("bin_edges_low", with_([*BASE, BASELINE, LONG.format(t="base"), EDGES], f"{INNER} AND feature = 'quarter'"), "bin_low")
def bin_edges_low(spark, sf):
    bins = hi.edges_to_bins(_edges(spark, sf, LOW, []), SEG)
    return bins.where("bin > 1").drop("bin_high")


@query("bin_edges_high", with_([*BASE, BASELINE, LONG.format(t="base"), EDGES], f"{INNER} AND feature IN ('sum_p4w', 'avg_past_12_weeks')"), "bin_low")
def bin_edges_high(spark, sf):
    bins = hi.edges_to_bins(_edges(spark, sf, [], HIGH), SEG)
    return bins.where("bin > 1").drop("bin_high")


@query("feature_histogram", with_(DRIFT, "SELECT week, stats_group, feature, bin, bin_count FROM hist_prod WHERE feature <> 'prediction'"))
def feature_histogram(spark, sf):
    return _histograms(spark, sf, LOW, HIGH)[1].drop("bin_low", "bin_high")


@query("feature_histogram_baseline", with_(DRIFT, "SELECT week, stats_group, feature, bin, bin_count FROM hist_base WHERE feature <> 'prediction'"))
def feature_histogram_baseline(spark, sf):
    return _histograms(spark, sf, LOW, HIGH)[0].drop("bin_low", "bin_high")


@query("prediction_histogram", with_(DRIFT, "SELECT week, stats_group, bin, bin_count FROM hist_prod WHERE feature = 'prediction'"))
def prediction_histogram(spark, sf):
    return _histograms(spark, sf, [], ["prediction"])[1].select("week", SEG, "bin", "bin_count")


def _alert(v: str, warn: float, crit: float) -> str:
    return f"CASE WHEN {v} > {crit} THEN 2 WHEN {v} > {warn} THEN 1 ELSE 0 END AS alert_level"


@query(
    "psi_alert",
    with_(
        [*BASE, "shares AS (SELECT week, stats_group, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY week) AS s FROM grouped GROUP BY 1, 2)",
         f"b AS (SELECT stats_group, GREATEST(AVG(s), 1e-10) AS p FROM shares WHERE week < {SPLIT_WEEK} GROUP BY 1)",
         f"x AS (SELECT week, SUM((GREATEST(s, 1e-10) - p) * LN(GREATEST(s, 1e-10) / p)) AS psi FROM shares JOIN b USING (stats_group) WHERE week >= {SPLIT_WEEK} GROUP BY 1)"],
        f"SELECT week, psi, {_alert('psi', 0.1, 0.2)} FROM x",
    ),
    "psi",
)
def psi_alert(spark, sf):
    shares = cut(hi.proportions(grouped(spark, sf), ["week"], SEG))
    return dr.psi(production(shares), baseline(shares), SEG, ["week"])


@query("feature_jsd_alert", with_([*DRIFT, f"j AS (SELECT week, stats_group, feature, {JSD} AS js_distance FROM cells WHERE feature <> 'prediction' GROUP BY ALL)"], f"SELECT *, {_alert('js_distance', 0.2, 0.45)} FROM j"), "js_distance")
def feature_jsd_alert(spark, sf):
    base, prod = _histograms(spark, sf, LOW, HIGH)
    return dr.js_distance(prod, base, ["week"], [SEG, "feature"])


@query("prediction_jsd_alert", with_([*DRIFT, f"j AS (SELECT week, stats_group, {JSD} AS js_distance FROM cells WHERE feature = 'prediction' GROUP BY ALL)"], f"SELECT *, {_alert('js_distance', 0.2, 0.45)} FROM j"), "js_distance")
def prediction_jsd_alert(spark, sf):
    base, prod = _histograms(spark, sf, [], ["prediction"])
    return dr.js_distance(prod, base, ["week"], [SEG])


@query("prediction_kl", with_(DRIFT, "SELECT week, stats_group, SUM(q * LN(q / p)) AS kl_divergence FROM cells WHERE feature = 'prediction' GROUP BY ALL"), "kl_divergence")
def prediction_kl(spark, sf):
    base, prod = _histograms(spark, sf, [], ["prediction"])
    return dr.kl_divergence(prod, base, ["week"], [SEG])


@query(
    "distribution_tests",
    with_(
        [*DRIFT, "gaps AS (SELECT week, stats_group, feature, ABS(SUM(q0 - p0) OVER (PARTITION BY week, stats_group, feature ORDER BY bin)) AS g FROM cells WHERE feature <> 'prediction')"],
        "SELECT week, stats_group, feature, MAX(g) AS ks_distance, SUM(g) AS wasserstein_bins FROM gaps GROUP BY ALL",
    ),
    "ks_distance wasserstein_bins",
)
def distribution_tests(spark, sf):
    base, prod = _histograms(spark, sf, LOW, HIGH)
    return dr.distribution_tests(prod, base, ["week"], [SEG, "feature"])


CATEGORIES = f"""cat AS (
  SELECT stats_group, f AS feature, v AS bin, COUNT(*) FILTER (week < {SPLIT_WEEK}) AS r, COUNT(*) FILTER (week >= {SPLIT_WEEK}) AS a
  FROM (SELECT week, stats_group, UNNEST(['brand', 'cust_category']) AS f, UNNEST([brand, cust_category]) AS v FROM grouped) GROUP BY ALL)"""


@query(
    "chi_square_drift",
    with_(
        [*BASE, CATEGORIES, "t AS (SELECT *, SUM(r) OVER w AS tr, SUM(a) OVER w AS ta FROM cat WINDOW w AS (PARTITION BY stats_group, feature))",
         "x AS (SELECT stats_group, feature, SUM(POWER(r - (r + a) * tr / (tr + ta), 2) / ((r + a) * tr / (tr + ta)) + POWER(a - (r + a) * ta / (tr + ta), 2) / ((r + a) * ta / (tr + ta))) AS chi_square, SUM(r + a) AS n FROM t GROUP BY 1, 2)"],
        "SELECT stats_group, feature, chi_square, SQRT(chi_square / n) AS cramers_v FROM x",
    ),
    "chi_square cramers_v",
)
def chi_square_drift(spark, sf):
    rows = stored_groups(spark, sf)
    count = lambda part: hi.category_shares(part, ["week"], SEG, ["brand", "cust_category"])
    return dr.chi_square(count(baseline(rows)), count(production(rows)), [SEG, "feature"])


@query(
    "univariate_drift",
    with_(
        [*BASE, PROD, BASELINE, LONG.format(t="base"), LONG.format(t="prod"), EDGES, HIST.format(t="base"), HIST.format(t="prod"), CATEGORIES,
         """both_sets AS (
              SELECT stats_group, feature, 'continuous' AS kind, CAST(bin AS VARCHAR) AS bin, b.n AS r, p.n AS a
              FROM (SELECT stats_group, feature, bin, SUM(bin_count) AS n FROM hist_base GROUP BY ALL) b
              JOIN (SELECT stats_group, feature, bin, SUM(bin_count) AS n FROM hist_prod GROUP BY ALL) p USING (stats_group, feature, bin)
              WHERE feature IN ('sum_p4w', 'avg_past_12_weeks')
              UNION ALL SELECT stats_group, feature, 'categorical', bin, r, a FROM cat WHERE feature = 'brand')""",
         """pq AS (SELECT stats_group, feature, kind, GREATEST(r / SUM(r) OVER w, 1e-10) AS p, GREATEST(a / SUM(a) OVER w, 1e-10) AS q
              FROM both_sets WINDOW w AS (PARTITION BY stats_group, feature))""",
         f"j AS (SELECT stats_group, feature, kind, {JSD} AS js_distance FROM pq GROUP BY ALL)"],
        "SELECT *, CAST(0.2 AS DOUBLE) AS threshold, js_distance > 0.2 AS alert FROM j",
    ),
    "js_distance",
)
def univariate_drift(spark, sf):
    rows = stored_groups(spark, sf)
    return dr.univariate_drift(baseline(rows), production(rows), SEG, continuous=HIGH, categorical=["brand"], exact=True)


# --- performance ----------------------------------------------------------------------------------------------------------

SUMS = """COUNT(*) AS n, SUM(ABS(y - prediction)) AS ae, SUM(ABS(y)) AS aa, SUM(POWER(y - prediction, 2)) AS se,
  CAST(COUNT(*) FILTER (y > 0 AND prediction > 0) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (y <= 0 AND prediction > 0) AS DOUBLE) AS fp,
  CAST(COUNT(*) FILTER (y > 0 AND prediction <= 0) AS DOUBLE) AS fn"""
F1 = """2 * (tp / GREATEST(tp + fp, 1e-10)) * (tp / GREATEST(tp + fn, 1e-10))
  / GREATEST(tp / GREATEST(tp + fp, 1e-10) + tp / GREATEST(tp + fn, 1e-10), 1e-10)"""


def levels_sql(source: str, dims: list[str], base: str) -> str:
    parts = []
    for d in dims:
        parts.append(f"SELECT {base}, '{d}' AS aggregated_col, {d} AS aggregated_value, {SUMS} FROM {source} GROUP BY {base}, {d}")
        parts.append(f"SELECT {base}, '{d}', 'full_model', {SUMS} FROM {source} GROUP BY {base}")
    return " UNION ALL ".join(parts)


def metrics_sql(source: str, dims: list[str], base: str) -> str:
    return f"""SELECT {base}, aggregated_col, aggregated_value, UNNEST(['wape', 'rmse', 'mae', 'f1_binary']) AS metric_col,
      UNNEST([ae / GREATEST(aa, 1e-10), SQRT(se / n), ae / n, {F1}]) AS metric_value FROM ({levels_sql(source, dims, base)})"""


VERSIONED = "versioned AS (SELECT *, 'v1' AS model_version FROM grouped)"
DIMS = ["stats_group", "cust_category"]
METRICS = [*BASE, VERSIONED, f"metrics AS ({metrics_sql('versioned', DIMS, 'week, model_version')})"]


def _metrics(spark, sf):
    return pf.metric_rollup(grouped(spark, sf).withColumn("model_version", F.lit("v1")), DIMS, "y", "prediction")


@query("metric_rollup", with_(METRICS, "SELECT * FROM metrics"), "metric_value")
def metric_rollup(spark, sf):
    return _metrics(spark, sf)


AVERAGES = f"averages AS (SELECT model_version, aggregated_col, aggregated_value, metric_col, AVG(metric_value) AS baseline_metric FROM metrics WHERE week < {SPLIT_WEEK} GROUP BY ALL)"


@query("metric_baseline", with_([*METRICS, AVERAGES], "SELECT * FROM averages"), "baseline_metric")
def metric_baseline(spark, sf):
    return pf.metric_baseline(baseline(_metrics(spark, sf)))


@query(
    "relative_drift_alert",
    with_(
        [*METRICS, AVERAGES,
         f"""changed AS (SELECT m.*, baseline_metric, (metric_value - baseline_metric) / GREATEST(ABS(baseline_metric), 1e-10) AS metric_drift
              FROM metrics m LEFT JOIN averages USING (model_version, aggregated_col, aggregated_value, metric_col) WHERE week >= {SPLIT_WEEK})"""],
        """SELECT *, CAST(CASE WHEN metric_col = 'f1_binary' THEN -0.15 ELSE 0.2 END AS DOUBLE) AS warning_threshold,
             CAST(CASE WHEN metric_col = 'f1_binary' THEN -0.3 ELSE 0.5 END AS DOUBLE) AS critical_threshold,
             CASE WHEN metric_col = 'f1_binary' THEN CASE WHEN metric_drift < -0.3 THEN 2 WHEN metric_drift < -0.15 THEN 1 ELSE 0 END
               ELSE CASE WHEN metric_drift > 0.5 THEN 2 WHEN metric_drift > 0.2 THEN 1 ELSE 0 END END AS alert_level FROM changed""",
    ),
    "metric_value baseline_metric metric_drift",
)
def relative_drift_alert(spark, sf):
    metrics = cut(_metrics(spark, sf))
    return al.relative_alert(production(metrics), pf.metric_baseline(baseline(metrics)))


IN_CONTROL = f"week >= {SPLIT_WEEK} AND week <= 200015"


@query(
    "sigma_alert",
    with_(
        [*METRICS,
         f"""stats AS (SELECT model_version, aggregated_col, aggregated_value, metric_col, COUNT(DISTINCT week) AS n_baseline_weeks,
               AVG(metric_value) AS mean_baseline, STDDEV_SAMP(metric_value) AS stddev_baseline FROM metrics WHERE {IN_CONTROL} GROUP BY ALL)""",
         """x AS (SELECT m.*, n_baseline_weeks, mean_baseline, stddev_baseline, GREATEST(COALESCE(stddev_baseline, 0), 1e-9) AS sd,
               CASE WHEN metric_col = 'f1_binary' THEN -1.0 ELSE 1.0 END AS sg
               FROM metrics m LEFT JOIN stats USING (model_version, aggregated_col, aggregated_value, metric_col) WHERE week > 200015)"""],
        """SELECT * EXCLUDE (sd, sg), mean_baseline + sg * 2 * sd AS warning_threshold, mean_baseline + sg * 3 * sd AS critical_threshold,
             CASE WHEN mean_baseline IS NULL THEN -1 WHEN sg * (metric_value - mean_baseline) >= 3 * sd THEN 2
               WHEN sg * (metric_value - mean_baseline) >= 2 * sd THEN 1 ELSE 0 END AS alert_level FROM x""",
    ),
    "metric_value mean_baseline stddev_baseline warning_threshold critical_threshold",
)
def sigma_alert(spark, sf):
    """Control limits from the first 15 production weeks, applied to the later ones."""
    metrics = cut(_metrics(spark, sf))
    early = metrics.where((F.col("week") >= SPLIT_WEEK) & (F.col("week") <= 200015))
    return al.sigma_alert(metrics.where("week > 200015"), early, early.select("model_version", "week"))


@query(
    "sigma_alert_models",
    with_(
        [*BASE, "versioned AS (SELECT *, 'sales_' || cust_category AS model_version FROM grouped)",
         f"metrics AS ({metrics_sql('versioned', ['stats_group'], 'week, model_version')})",
         """cuts AS (SELECT 'sales_' || cust_category AS model_version, make_date(1999, 12, 27) + 7 * CAST(COUNT(DISTINCT brand) AS INTEGER) AS cutoff FROM grouped GROUP BY 1)""",
         """weeks AS (SELECT DISTINCT model_version, CAST(isoyear(day) * 100 + weekofyear(day) AS INTEGER) AS week FROM cuts,
              UNNEST(generate_series(CAST(cutoff AS TIMESTAMP), CAST(cutoff + 15 * 7 - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS g(day))""",
         """stats AS (SELECT model_version, aggregated_col, aggregated_value, metric_col, AVG(metric_value) AS mu, STDDEV_SAMP(metric_value) AS sd
              FROM metrics JOIN weeks USING (model_version, week) GROUP BY ALL)""",
         """x AS (SELECT m.*, mu, GREATEST(COALESCE(sd, 0), 1e-9) AS sd, CASE WHEN metric_col = 'f1_binary' THEN -1.0 ELSE 1.0 END AS sg
              FROM metrics m LEFT JOIN stats USING (model_version, aggregated_col, aggregated_value, metric_col) WHERE week > 200024)"""],
        """SELECT week, model_version, aggregated_value, metric_col, metric_value, CASE WHEN mu IS NULL THEN -1 WHEN sg * (metric_value - mu) >= 3 * sd THEN 2
             WHEN sg * (metric_value - mu) >= 2 * sd THEN 1 ELSE 0 END AS alert_level FROM x""",
    ),
    "metric_value",
)
def sigma_alert_models(spark, sf):
    """Control-chart alerts of several models, each with the 15 weeks from its own cut-off date as baseline."""
    rows = stored_groups(spark, sf).withColumn("model_version", F.concat(F.lit("sales_"), F.col("cust_category")))
    metrics = cut(pf.metric_rollup(rows, [SEG], "y", "prediction"))
    # a model's cut-off lies as many weeks after the turn of the year as it has brands
    start = F.lit("1999-12-27").cast("date")
    cuts = rows.groupBy("model_version").agg(F.date_add(start, 7 * F.countDistinct("brand").cast("int")).alias("cutoff"))
    out = al.sigma_alert(metrics.where("week > 200024"), metrics, weeks_after(cuts, "cutoff", 15))
    return out.select("week", "model_version", "aggregated_value", "metric_col", "metric_value", "alert_level")


@query(
    "thresholded_report",
    with_(
        [*BASE, BASELINE, PROD, CATEGORIES,
         "pq AS (SELECT stats_group, feature, GREATEST(r / SUM(r) OVER w, 1e-10) AS p, GREATEST(a / SUM(a) OVER w, 1e-10) AS q FROM cat WINDOW w AS (PARTITION BY stats_group, feature))",
         f"j AS (SELECT stats_group, feature, {JSD} AS js_distance FROM pq GROUP BY ALL)"],
        "SELECT stats_group, feature, js_distance, CASE feature WHEN 'brand' THEN CAST(0.05 AS DOUBLE) END AS threshold, COALESCE(feature = 'brand' AND js_distance > 0.05, FALSE) AS alert FROM j",
    ),
    "js_distance",
)
def thresholded_report(spark, sf):
    """Categorical drift with a threshold per column from a table; a column without threshold never alerts."""
    rows = stored_groups(spark, sf)
    report = dr.univariate_drift(baseline(rows), production(rows), SEG, categorical=["brand", "cust_category"])
    limits = spark.createDataFrame([("brand", 0.05)], "feature string, threshold double")
    return dr.with_thresholds(report.select(SEG, "feature", "js_distance"), limits, "feature", "js_distance")


@query(
    "mape_variants",
    with_(
        [TX, PANEL, f"lagged AS (SELECT *, {lag_sql(1)} FROM panel)"],
        """SELECT brand, 100 * AVG(ABS(w_m1_total - y) / NULLIF(w_m1_total, 0)) AS mape_skip,
             100 * AVG(ABS(w_m1_total - y) / ABS(w_m1_total)) FILTER (ABS(w_m1_total) > 1e-8) AS mape_mask,
             100 * AVG(ABS(w_m1_total - y) / CASE WHEN w_m1_total = 0 THEN 1 ELSE w_m1_total END) AS mape_one FROM lagged GROUP BY 1""",
    ),
    "mape_skip mape_mask mape_one",
)
def mape_variants(spark, sf):
    """Percentage error with the lag as actual (it has zeros) and the week's sales as forecast."""
    rows = guarded_lags(weekly_sales(spark, sf), SERIES_IDS, "week", "y", 1)
    return pf.mape_variants(rows, ["brand"], "w_m1_total", "y")


SUMMARY = """COUNT(*) AS predictions, AVG(prediction) AS avg_predicted, AVG(y) AS avg_actual, AVG(ABS(y - prediction)) AS mae,
  SQRT(AVG(POWER(y - prediction, 2))) AS rmse, 100 * AVG(ABS(y - prediction) / NULLIF(ABS(y), 0)) AS mape"""


@query("segment_summary", with_(BASE, f"SELECT stats_group AS segment, {SUMMARY} FROM grouped GROUP BY 1 UNION ALL SELECT 'overall', {SUMMARY} FROM grouped"), "avg_predicted avg_actual mae rmse mape")
def segment_summary(spark, sf):
    return pf.segment_summary(grouped(spark, sf), SEG, "y", "prediction")


@query(
    "performance_status",
    with_(BASE, "SELECT stats_group AS segment, SQRT(AVG(POWER(y - prediction, 2))) AS rmse, CASE WHEN SQRT(AVG(POWER(y - prediction, 2))) > 45 THEN 'HIGH ERROR' WHEN SQRT(AVG(POWER(y - prediction, 2))) > 30 THEN 'MODERATE ERROR' ELSE 'LOW ERROR' END AS status FROM grouped GROUP BY 1"),
    "rmse",
)
def performance_status(spark, sf):
    out = pf.segment_summary(grouped(spark, sf), SEG, "y", "prediction").where("segment <> 'overall'")
    return out.select("segment", "rmse", al.performance_status("rmse", (30.0, 45.0)).alias("status"))


FLAG_IDS = "customer_id, brand, week"


@query(
    "forecast_metrics",
    with_(
        [TX, PANEL, f"lagged AS (SELECT *, {lag_sql(1)} FROM panel)",
         f"seg AS (SELECT customer_id, brand, week, y, w_m1_total AS prediction, 'v1' AS model_version, 'quartile_' || NTILE(4) OVER (PARTITION BY week ORDER BY w_m1_total, customer_id, brand) AS volume_quartile FROM lagged)",
         f"m AS ({metrics_sql('seg', ['volume_quartile'], 'week, model_version')})"],
        """SELECT sha256('naive||' || model_version || '||' || week || '||' || aggregated_col || '||' || aggregated_value || '||' || metric_col) AS record_id, * FROM m""",
    ),
    "metric_value",
)
def forecast_metrics(spark, sf):
    """Weekly panel, last week's sales as forecast, volume quartile of the week as segment, error metrics with record ids."""
    rows = guarded_lags(weekly_sales(spark, sf), SERIES_IDS, "week", "y", 1).withColumnRenamed("w_m1_total", "prediction")
    ranked = add_ntile(rows, ["week"], ["prediction", "customer_id", "brand"], 4, "_q").withColumns(
        {"volume_quartile": F.concat(F.lit("quartile_"), F.col("_q").cast("string")), "model_version": F.lit("v1")}
    )
    out = pf.metric_rollup(ranked, ["volume_quartile"], "y", "prediction")
    key = record_id(F.lit("naive"), "model_version", "week", "aggregated_col", "aggregated_value", "metric_col")
    return out.select(key.alias("record_id"), *out.columns)


@query(
    "forecast_vs_sales",
    with_(
        [*BASE,
         f"fc AS (SELECT customer_id, brand, week, m AS model_uri, prediction * f AS prediction FROM prod_rows, (VALUES ('models:/naive/1', 1.0), ('models:/naive/2', 0.9)) AS v(m, f))".replace("prod_rows", f"(SELECT * FROM grouped WHERE week >= {SPLIT_WEEK})"),
         f"sales AS (SELECT customer_id, brand, week, y AS actual FROM panel WHERE week >= {SPLIT_WEEK})",
         """paired AS (SELECT fc.customer_id, fc.brand, fc.week, model_uri, COALESCE(actual, 0) AS actual, prediction FROM fc LEFT JOIN sales USING (customer_id, brand, week)
              UNION ALL SELECT s.customer_id, s.brand, s.week, m, actual, 0 FROM sales s CROSS JOIN (SELECT DISTINCT model_uri AS m FROM fc) x
              WHERE NOT EXISTS (SELECT 1 FROM fc WHERE fc.customer_id = s.customer_id AND fc.brand = s.brand AND fc.week = s.week))"""],
        """SELECT week, model_uri, COUNT(*) AS row_count, SUM(actual) AS actual, SUM(prediction) AS prediction,
             SUM(ABS(actual - prediction)) / GREATEST(SUM(ABS(actual)), 1e-10) AS wape FROM paired GROUP BY 1, 2""",
    ),
    "actual prediction wape",
)
def forecast_vs_sales(spark, sf):
    """Two forecasts against all sales; sales of weeks that follow no sale have no forecast and count against both."""
    rows = production(grouped(spark, sf)).select(*ROW_IDS, "prediction")
    models = F.array(*[F.struct(F.lit(m).alias("u"), F.lit(f).alias("f")) for m, f in (("models:/naive/1", 1.0), ("models:/naive/2", 0.9))])
    fc = rows.withColumn("m", F.explode(models)).select(*ROW_IDS, F.col("m.u").alias("model_uri"), (F.col("prediction") * F.col("m.f")).alias("prediction"))
    sales = production(weekly_sales(spark, sf)).withColumnRenamed("y", "actual")
    both = pf.forecast_vs_sales_sums(cut(fc), sales, ROW_IDS, ["week"])
    return both.select(
        "week", "model_uri", "row_count", "actual", "prediction", (F.col("absolute_error") / F.greatest("absolute_actual", F.lit(1e-10))).alias("wape")
    )


@query(
    "distribution_compare",
    with_(
        BASE,
        f"""SELECT CASE WHEN week < {SPLIT_WEEK} THEN 'BASELINE' ELSE 'INFERENCE' END AS source, stats_group, COUNT(*) AS row_count,
             AVG(sum_p4w) AS avg_sum_p4w, STDDEV_SAMP(sum_p4w) AS std_sum_p4w, AVG(y) AS avg_y, STDDEV_SAMP(y) AS std_y FROM grouped GROUP BY 1, 2""",
    ),
    "avg_sum_p4w std_sum_p4w avg_y std_y",
)
def distribution_compare(spark, sf):
    rows = stored_groups(spark, sf)
    return pf.compare_distributions({"BASELINE": baseline(rows), "INFERENCE": production(rows)}, SEG, ["sum_p4w", "y"])


@query(
    "paired_actuals",
    with_(
        [*BASE, "actuals AS (SELECT customer_id, week, SUM(y) AS actual FROM panel GROUP BY 1, 2)"],
        "SELECT customer_id, brand, week, prediction, COALESCE(actual, 0) AS actual FROM grouped LEFT JOIN actuals USING (customer_id, week)",
    ),
    "prediction actual",
)
def paired_actuals(spark, sf):
    """Forecasts with actuals that lack the product key: each actual meets every product row."""
    actuals = weekly_sales(spark, sf).groupBy("customer_id", "week").agg(F.sum("y").alias("actual"))
    return pf.pair_actuals(grouped(spark, sf).select(*ROW_IDS, "prediction"), actuals, ["customer_id", "week"], "actual", "left")


@query(
    "null_segment_drift",
    with_(
        [*DRIFT, f"j AS (SELECT week, NULLIF(stats_group, 'group_stat_1') AS stats_group, feature, {JSD} AS js_distance FROM cells WHERE feature <> 'prediction' GROUP BY ALL)"],
        f"SELECT *, {_alert('js_distance', 0.2, 0.45)} FROM j",
    ),
    "js_distance",
)
def null_segment_drift(spark, sf):
    """Drift per group where one group has no name: it is binned, counted and compared like the others."""
    rows = store(stored_groups(spark, sf).withColumn(SEG, F.nullif(F.col(SEG), F.lit("group_stat_1"))))
    edges = hi.bin_edges(baseline(rows), SEG, LOW, HIGH, exact=True)
    hist = store(hi.histogram(rows, ["week"], SEG, [*LOW, *HIGH], edges))
    return dr.js_distance(production(hist), baseline(hist), ["week"], [SEG, "feature"])
