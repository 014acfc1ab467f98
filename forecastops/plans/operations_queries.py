"""Registered queries: landing datasets, training, scoring, model versions, feature store, event monitors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastops.functions.keys import first_number, number_or_zero
from forecastops.operators import alerts as al
from forecastops.operators import drift as dr
from forecastops.operators import feature_store as fs
from forecastops.operators import histograms as hi
from forecastops.operators import lifecycle as lc
from forecastops.operators import performance as pf
from forecastops.operators import reports as rp
from forecastops.operators import scoring as sc
from forecastops.operators import split as sp
from forecastops.operators import training as tr
from forecastops.plans.frames import ROW_IDS, baseline, grouped, production, stored_groups, weekly_sales
from forecastops.plans.monitoring_queries import EDGES, F1, HIST, JSD, SHARES, SUMS
from forecastops.plans.registry import BASE, PANEL, SPLIT_WEEK, TX, query, with_
from forecastops.plans.segment_queries import BUCKET, RANKED
from forecastops.session import cut, shared_folder
from forecastops.sources import landing as la
from forecastops.streaming import monitor as mo

SEG = "stats_group"


def _orders(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _fresh(spark, name: str) -> str:
    """A folder of its own for one run, in the folder all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- landing ----------------------------------------------------------------------------------------------------------------

UPSERTED = """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) < 1998
  UNION ALL SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER), 'X', 2 * o_totalprice FROM orders WHERE year(o_orderdate) >= 1998
  EXCEPT ALL SELECT o_orderkey, 1997, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) = 1997
  UNION ALL SELECT o_orderkey, 1997, 'X', 2 * o_totalprice FROM orders WHERE year(o_orderdate) = 1997"""


def _upsert_sides(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    changed = orders.where("year >= 1997").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": 2 * F.col("o_totalprice")})
    return orders.where("year < 1998"), changed


@query("upsert_merge", UPSERTED, "o_totalprice")
def upsert_merge(spark, sf):
    """Orders before 1998 with all orders from 1997 on replaced or added."""
    target, source = _upsert_sides(spark, sf)
    return la.upsert(target, source, ["o_orderkey"])


@query("upsert_stored", UPSERTED, "o_totalprice")
def upsert_stored(spark, sf):
    """The same upsert on a stored dataset partitioned by year, applied twice: the second run changes nothing."""
    target, source = _upsert_sides(spark, sf)
    path = _fresh(spark, "orders")
    target.write.partitionBy("year").parquet(path)
    for _ in range(2):
        la.upsert_path(spark, path, source, ["o_orderkey", "year"], ["year"])
    return spark.read.schema(source.schema).parquet(path)


@query("missing_slices", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders EXCEPT SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE o_orderstatus = 'F'")
def missing_slices(spark, sf):
    orders = _orders(spark, sf).withColumn("year", F.year("o_orderdate"))
    return la.missing_slices(orders, orders.where("o_orderstatus = 'F'"), ["o_custkey", "year"])


@query("env_sync", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')", "o_totalprice")
def env_sync(spark, sf):
    """Rows of customers the other environment has nothing of."""
    orders = _orders(spark, sf)
    return la.unsynced_rows(orders, orders.where("o_orderstatus = 'O'"), ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    rows = _orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return fs.latest_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "first_k_per_key",
    """SELECT o_orderpriority, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 2""",
)
def first_k_per_key(spark, sf):
    """Two sample orders per priority."""
    return fs.first_rows(_orders(spark, sf).select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], ["o_orderkey"], 2)


def _records(spark, sf, version: str) -> DataFrame:
    scored = production(grouped(spark, sf))
    return sc.prediction_records(scored, "naive", version, SEG, ["customer_id", "brand"], unit="UNIT", loaded_at=F.lit("2001-12-31").cast("timestamp"))


@query(
    "prediction_records",
    with_(
        BASE,
        f"""SELECT sha256('naive||v1||' || week || '||' || customer_id || '||' || brand || '||' || stats_group) AS record_id, 'naive' AS model_name,
             'v1' AS model_version, CAST(customer_id AS VARCHAR) AS customer_id, CAST(week AS VARCHAR) AS week, 'stats_group' AS partition_col,
             CAST(CAST(make_date(CAST(week // 100 AS INTEGER), 1, 1) + 7 * CAST(week % 100 - 1 AS INTEGER) AS DATE) AS VARCHAR) AS data_date, prediction, 'UNIT' AS bkcc,
             strftime(make_date(CAST(week // 100 AS INTEGER), 1, 1) + 7 * CAST(week % 100 - 1 AS INTEGER), '%Y%m') AS calmonth
           FROM grouped WHERE week >= {SPLIT_WEEK}""",
    ),
    "prediction",
)
def prediction_records(spark, sf):
    """Contract rows, the key bag shown key by key."""
    bag = F.col("entity_map")
    return _records(spark, sf, "v1").select(
        "record_id", "model_name", "model_version", *[bag[k].alias(k) for k in ("customer_id", "week", "partition_col", "data_date")],
        "prediction", "bkcc", "calmonth",
    )


@query("prediction_view", with_(BASE, f"SELECT 'naive' AS model_name, 'v1' AS model_version, customer_id, brand, week, stats_group, prediction FROM grouped WHERE week >= {SPLIT_WEEK}"), "prediction")
def prediction_view(spark, sf):
    return sc.prediction_view(_records(spark, sf, "v1"), {"customer_id": "int", "brand": "string"}, SEG)


@query(
    "new_combos",
    with_(
        BASE,
        f"""SELECT DISTINCT week, v AS model_version FROM grouped, (VALUES ('v1'), ('v2')) AS x(v) WHERE week >= {SPLIT_WEEK}
           EXCEPT SELECT week, 'v1' FROM grouped WHERE week < 200030 AND w_m1_total > 0""",
    ),
)
def new_combos(spark, sf):
    """Weeks and versions with predictions but without a landed metric."""
    predictions = _records(spark, sf, "v1").unionByName(_records(spark, sf, "v2"))
    metrics = pf.metric_rollup(grouped(spark, sf).where("w_m1_total > 0 and week < 200030").withColumn("model_version", F.lit("v1")), [SEG], "y", "prediction")
    landed = metrics.withColumn("entity_map", F.create_map(F.lit("week"), F.col("week").cast("string")))
    return la.new_combos(predictions, landed, SEG, "wape", SPLIT_WEEK)


# --- training and scoring ---------------------------------------------------------------------------------------------------

FIT = "fit AS (SELECT stats_group, COUNT(*) AS n_rows, regr_slope(y, w_m1_total) AS slope, regr_intercept(y, w_m1_total) AS intercept, SQRT(GREATEST(regr_syy(y, w_m1_total) - regr_slope(y, w_m1_total) * regr_sxy(y, w_m1_total), 0) / COUNT(*)) AS train_rmse FROM grouped GROUP BY 1)"


@query("grouped_fit", with_([*BASE, FIT], "SELECT * FROM fit"), "slope intercept train_rmse")
def grouped_fit(spark, sf):
    fitted = tr.grouped_fit(grouped(spark, sf), SEG, ["w_m1_total"], "y")
    return fitted.select(SEG, "n_rows", F.get("coefficients", F.lit(0)).alias("slope"), "intercept", "train_rmse")


@query("partitioned_score", with_([*BASE, FIT], "SELECT customer_id, brand, week, stats_group, intercept + slope * w_m1_total AS score FROM grouped JOIN fit USING (stats_group)"), "score")
def partitioned_score(spark, sf):
    rows = stored_groups(spark, sf)
    models = tr.grouped_fit(rows, SEG, ["w_m1_total"], "y")
    return sc.partitioned_score(rows, models, SEG, ["w_m1_total"], prediction="score").select(*ROW_IDS, SEG, "score")


CANDIDATES = """cand AS (
  SELECT stats_group, candidate, COUNT(*) AS n_rows, SQRT(AVG(POWER(p - y, 2))) AS rmse, AVG(ABS(p - y)) AS mae FROM (
    SELECT stats_group, y, UNNEST(['naive', 'mean_4', 'mean_12', 'linear']) AS candidate,
           UNNEST([w_m1_total, sum_past_4_weeks / 4, avg_past_12_weeks, intercept + slope * w_m1_total]) AS p FROM grouped JOIN fit USING (stats_group)) GROUP BY 1, 2)"""


def _candidates(spark, sf):
    rows = stored_groups(spark, sf)
    scored = sc.partitioned_score(rows, tr.grouped_fit(rows, SEG, ["w_m1_total"], "y"), SEG, ["w_m1_total"], prediction="linear")
    columns = {"naive": "w_m1_total", "mean_4": F.col("sum_past_4_weeks") / 4, "mean_12": "avg_past_12_weeks", "linear": "linear"}
    return tr.candidate_metrics(scored, SEG, "y", columns)


@query("candidate_metrics", with_([*BASE, FIT, CANDIDATES], "SELECT * FROM cand"), "rmse mae")
def candidate_metrics(spark, sf):
    return _candidates(spark, sf)


@query("best_candidate", with_([*BASE, FIT, CANDIDATES], "SELECT * FROM cand QUALIFY ROW_NUMBER() OVER (PARTITION BY stats_group ORDER BY rmse, candidate) = 1"), "rmse mae")
def best_candidate(spark, sf):
    return tr.best_candidate(_candidates(spark, sf), SEG)


PENALTIES = (0.0, 1e3, 1e5, 1e7)
TRIALS = f"""sides AS (SELECT stats_group, w_m1_total AS x, y, rn > FLOOR(n * CAST(0.8 AS DOUBLE)) AS is_test FROM placed),
fits AS (
  SELECT stats_group, t AS trial, COUNT(*) AS sample_size, regr_sxy(y, x) / (regr_sxx(y, x) + ridge) AS b, AVG(y) AS my, AVG(x) AS mx
  FROM sides, (VALUES {", ".join(f"({i}, {p})" for i, p in enumerate(PENALTIES))}) AS v(t, ridge) WHERE NOT is_test GROUP BY stats_group, t, ridge),
trials AS (
  SELECT f.stats_group, f.trial, f.sample_size, COUNT(*) AS validation_size, SQRT(AVG(POWER(s.y - (my + b * (s.x - mx)), 2))) AS val_rmse
  FROM fits f JOIN sides s ON s.stats_group = f.stats_group AND s.is_test GROUP BY ALL)"""


def _trials(spark, sf):
    rows = sp.temporal_split(stored_groups(spark, sf), SEG, "week", ["customer_id", "brand"])
    trials = [{"trial": i, "ridge": p, "features": [0]} for i, p in enumerate(PENALTIES)]
    return tr.trial_search(rows, SEG, ["w_m1_total"], "y", trials).drop("params")


@query("trial_search", with_([*BASE, RANKED, TRIALS], "SELECT * FROM trials"), "val_rmse")
def trial_search(spark, sf):
    """Four penalties per group, fitted on the older 80 percent of rows and judged on the newer."""
    return _trials(spark, sf)


@query("best_trial", with_([*BASE, RANKED, TRIALS], "SELECT * FROM trials QUALIFY ROW_NUMBER() OVER (PARTITION BY stats_group ORDER BY val_rmse, trial) = 1"), "val_rmse")
def best_trial(spark, sf):
    return tr.best_trial(_trials(spark, sf), SEG)


TWO = ["w_m1_total", "sum_past_4_weeks"]
DRAWN = tr.draw_trials(TWO)
#: ridge regression on one or two features in closed form, from centred sums
TWO_TRIALS = f"""halves AS (SELECT stats_group, w_m1_total AS x1, sum_past_4_weeks AS x2, y, {BUCKET} < 20 AS is_test FROM grouped),
draws(trial, ridge, u1, u2) AS (VALUES {", ".join(f"({t['trial']}, CAST({t['ridge']!r} AS DOUBLE), {int(0 in t['features'])}, {int(1 in t['features'])})" for t in DRAWN)}),
sums AS (SELECT stats_group, COUNT(*) AS n, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, regr_sxx(y, x1) AS s11, regr_sxx(y, x2) AS s22, regr_sxy(x2, x1) AS s12,
  regr_sxy(y, x1) AS s1, regr_sxy(y, x2) AS s2 FROM halves WHERE NOT is_test GROUP BY 1),
slopes AS (SELECT *, CASE WHEN u1 = 0 THEN 0 WHEN u2 = 0 THEN s1 / (s11 + ridge) ELSE ((s22 + ridge) * s1 - s12 * s2) / ((s11 + ridge) * (s22 + ridge) - s12 * s12) END AS b1,
  CASE WHEN u2 = 0 THEN 0 WHEN u1 = 0 THEN s2 / (s22 + ridge) ELSE ((s11 + ridge) * s2 - s12 * s1) / ((s11 + ridge) * (s22 + ridge) - s12 * s12) END AS b2 FROM sums, draws)"""


@query(
    "random_trial_search",
    with_([*BASE, TWO_TRIALS], "SELECT s.stats_group, trial, n AS sample_size, COUNT(*) AS validation_size, SQRT(AVG(POWER(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2))) AS val_rmse FROM slopes s JOIN halves h ON h.stats_group = s.stats_group AND h.is_test GROUP BY 1, 2, 3"),
    "val_rmse",
)
def random_trial_search(spark, sf):
    """Random search over penalties and subsets of two features (15 draws) per group."""
    return tr.trial_search(sp.random_split(grouped(spark, sf), ROW_IDS), SEG, TWO, "y", DRAWN).drop("params")


@query("unsearched_segments", with_(BASE, "SELECT CAST(customer_id AS VARCHAR) AS customer_id, COUNT(*) AS n_rows, COUNT(*) FILTER (week < 200001) AS sample_size, CASE WHEN COUNT(*) < 400 THEN 'rows' WHEN COUNT(*) FILTER (week < 200001) < 300 THEN 'sample' END AS reason FROM grouped GROUP BY 1 HAVING reason IS NOT NULL"))
def unsearched_segments(spark, sf):
    """Outlets with too few rows, or too few of them to fit on, for a search."""
    rows = grouped(spark, sf).withColumns({"is_test": F.col("week") >= SPLIT_WEEK, "customer_id": F.col("customer_id").cast("string")})
    return tr.unsearched_segments(rows, "customer_id", "y", min_rows=400, min_sample=300)


TWO_FIT = """two AS (SELECT stats_group, COUNT(*) AS n_rows, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, regr_sxx(y, x1) AS s11, regr_sxx(y, x2) AS s22, regr_sxy(x2, x1) AS s12,
  regr_sxy(y, x1) AS s1, regr_sxy(y, x2) AS s2 FROM (SELECT stats_group, w_m1_total AS x1, sum_past_4_weeks AS x2, y FROM grouped) GROUP BY 1),
solved AS (SELECT *, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) AS b2 FROM two)"""


@query("grouped_fit_two", with_([*BASE, TWO_FIT], "SELECT stats_group, n_rows, b1, b2, my - b1 * m1 - b2 * m2 AS intercept FROM solved WHERE s11 * s22 - s12 * s12 > 1e-6 * s11 * s22"), "b1 b2 intercept")
def grouped_fit_two(spark, sf):
    """Fits of two features; groups whose features are collinear have no unique fit and are not shown."""
    rows = cut(grouped(spark, sf))
    fitted = tr.grouped_fit(rows, SEG, TWO, "y")
    spread = rows.groupBy(SEG).agg((1 - F.pow(F.corr(*TWO), 2)).alias("apart")).where("apart > 1e-6")
    slope = lambda i: F.get("coefficients", F.lit(i)).alias(f"b{i + 1}")
    return fitted.join(spread, SEG).select(SEG, "n_rows", slope(0), slope(1), "intercept")


@query(
    "resolved_params",
    with_(
        [*BASE,
         "runs AS (SELECT stats_group, brand AS params, SQRT(AVG(POWER(y - prediction, 2))) AS val_rmse, SUM(y) AS created_at FROM grouped GROUP BY 1, 2)",
         "p1 AS (SELECT stats_group, arg_min(params, val_rmse) AS p FROM runs WHERE stats_group IN ('group_stat_0', 'group_stat_1') GROUP BY 1)",
         "p2 AS (SELECT stats_group, arg_max(params, created_at) AS p FROM runs WHERE stats_group IN ('group_stat_1', 'group_stat_2') GROUP BY 1)"],
        """SELECT stats_group, COALESCE(p1.p, p2.p, '{"ridge": 1.0}') AS params,
             CASE WHEN p1.p IS NOT NULL THEN 'search' WHEN p2.p IS NOT NULL THEN 'table' ELSE 'default' END AS origin
           FROM (SELECT DISTINCT stats_group FROM grouped) g LEFT JOIN p1 USING (stats_group) LEFT JOIN p2 USING (stats_group)""",
    ),
)
def resolved_params(spark, sf):
    """Parameters per group: best run, else latest table row, else default."""
    rows = stored_groups(spark, sf)
    runs = rows.groupBy(SEG, F.col("brand").alias("params")).agg(
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).alias("val_rmse"), F.sum("y").alias("created_at")
    )
    primary, fallback = runs.where("stats_group <= 'group_stat_1'"), runs.where("stats_group in ('group_stat_1', 'group_stat_2')")
    return tr.resolve_params(rows, SEG, primary, fallback, {"ridge": 1.0})


@query("representatives", with_(BASE, "SELECT stats_group, MIN(customer_id) AS customer_id, MIN(brand) AS brand, MIN(sum_p4w) AS sum_p4w FROM grouped GROUP BY 1"), "sum_p4w")
def representatives(spark, sf):
    return tr.representatives(grouped(spark, sf), SEG, ["customer_id", "brand", "sum_p4w"])


@query("scoring_batches", with_([TX, PANEL], f"SELECT {BUCKET.replace('% 100', '% 8')} AS batch, COUNT(*) AS row_count, SUM(y) AS y FROM panel GROUP BY 1"), "y")
def scoring_batches(spark, sf):
    """The panel in eight batches by key hash, counted."""
    out = sc.scoring_batches(weekly_sales(spark, sf), ROW_IDS, 8)
    return out.groupBy("batch").agg(F.count(F.lit(1)).alias("row_count"), F.sum("y").alias("y"))


@query(
    "assigned_groups",
    with_(BASE, "SELECT p.customer_id, p.brand, p.week, g.last_group FROM panel p LEFT JOIN (SELECT customer_id, brand, arg_max(stats_group, week) AS last_group FROM grouped GROUP BY 1, 2) g USING (customer_id, brand)"),
)
def assigned_groups(spark, sf):
    """Every series row with the group its series was last in; series that never sold in a row are unmapped."""
    mapping = grouped(spark, sf).groupBy("customer_id", "brand").agg(F.max_by(SEG, "week").alias("last_group"))
    return sc.assign_groups(weekly_sales(spark, sf).select(*ROW_IDS), mapping, ["customer_id", "brand"], "last_group")


@query("absent_groups", with_(BASE, "SELECT DISTINCT week, brand FROM panel EXCEPT SELECT week, brand FROM grouped"))
def absent_groups(spark, sf):
    """Expected (week, brand) groups for which no row is ready to be scored, all found by one anti join."""
    return la.missing_slices(weekly_sales(spark, sf), grouped(spark, sf), ["week", "brand"])


@query("canary_split", with_([TX, PANEL], f"SELECT customer_id, brand, week, CASE WHEN {BUCKET} < 30 THEN 'candidate' ELSE 'production' END AS route FROM panel"))
def canary_split(spark, sf):
    return sc.canary_split(weekly_sales(spark, sf), ROW_IDS, 30).select(*ROW_IDS, "route")


@query(
    "canary_score",
    with_(
        [*BASE,
         f"old AS (SELECT stats_group, regr_slope(y, w_m1_total) AS s, regr_intercept(y, w_m1_total) AS i FROM grouped WHERE week < {SPLIT_WEEK} GROUP BY 1)",
         f"new AS (SELECT stats_group, regr_slope(y, w_m1_total) AS s, regr_intercept(y, w_m1_total) AS i FROM grouped WHERE week >= {SPLIT_WEEK} GROUP BY 1)",
         f"routed AS (SELECT *, {BUCKET} < 30 AS c FROM grouped)"],
        """SELECT customer_id, brand, week, CASE WHEN c THEN 'v2' ELSE 'v1' END AS model_version,
             CASE WHEN c THEN new.i + new.s * w_m1_total ELSE old.i + old.s * w_m1_total END AS score
           FROM routed JOIN old USING (stats_group) JOIN new USING (stats_group)""",
    ),
    "score",
)
def canary_score(spark, sf):
    """30 percent of the keys scored by the newer fit, the rest by the older."""
    rows = stored_groups(spark, sf)
    fit = lambda part, v: tr.models_frame(spark, tr.grouped_fit(part, SEG, ["w_m1_total"], "y"), "linear", v)
    out = sc.canary_score(rows.drop("prediction"), ROW_IDS, 30, fit(production(rows), "v2"), fit(baseline(rows), "v1"), SEG, ["w_m1_total"])
    return out.select(*ROW_IDS, "model_version", F.col("prediction").alias("score"))


def _shadow(spark, sf):
    rows = cut(production(grouped(spark, sf))).withColumnRenamed("y", "actual")
    mean = rows.withColumn("prediction", F.col("sum_past_4_weeks") / 4)
    return pf.compare_versions(mean, rows, rows, ROW_IDS)


@query("version_compare", with_(BASE, f"SELECT customer_id, brand, week, sum_past_4_weeks / 4 AS candidate, prediction AS production, y AS actual, sum_past_4_weeks / 4 - prediction AS difference FROM grouped WHERE week >= {SPLIT_WEEK}"), "candidate production actual difference")
def version_compare(spark, sf):
    return _shadow(spark, sf)


VERSION_METRICS = "SQRT(AVG(POWER({p} - y, 2))), AVG(ABS({p} - y)), 100 * AVG(ABS({p} - y) / CASE WHEN y = 0 THEN 1 ELSE ABS(y) END)"


@query(
    "version_metrics",
    with_(
        [*BASE, f"m AS (SELECT [{VERSION_METRICS.format(p='sum_past_4_weeks / 4')}] AS c, [{VERSION_METRICS.format(p='prediction')}] AS p FROM grouped WHERE week >= {SPLIT_WEEK})"],
        "SELECT UNNEST(['rmse', 'mae', 'mape']) AS metric_col, UNNEST(c) AS candidate, UNNEST(p) AS production, UNNEST([c[1] - p[1], c[2] - p[2], c[3] - p[3]]) AS difference FROM m",
    ),
    "candidate production difference",
)
def version_metrics(spark, sf):
    return pf.version_metrics(_shadow(spark, sf))


# --- versions -----------------------------------------------------------------------------------------------------------------

VERSIONS = """versions AS (
  SELECT 'forecast_' || substr(o_orderpriority, 1, 1) AS model_name, 'v' || CAST(year(o_orderdate) AS VARCHAR) AS model_version,
         CAST(MAX(o_orderdate) AS DATE) AS created_on FROM orders GROUP BY 1, 2),
aged AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY created_on DESC, model_version DESC) AS age FROM versions),
aliased AS (SELECT model_name, model_version, created_on, CASE age WHEN 1 THEN 'CANDIDATE' WHEN 2 THEN 'PRODUCTION' WHEN 3 THEN 'BACKUP' END AS alias FROM aged)"""


def _aliased(spark, sf):
    """Version table: a model per order priority, a version per year, created with the year's last order."""
    versions = _orders(spark, sf).groupBy(
        F.concat(F.lit("forecast_"), F.substring("o_orderpriority", 1, 1)).alias("model_name"),
        F.concat(F.lit("v"), F.year("o_orderdate").cast("string")).alias("model_version"),
    ).agg(F.max("o_orderdate").alias("created_on"))
    return lc.alias_by_recency(versions)


def _moved(case: str) -> str:
    return with_([VERSIONS], f"SELECT model_name, model_version, created_on, CASE alias {case} END AS alias FROM aliased")


@query("alias_by_recency", with_([VERSIONS], "SELECT * FROM aliased"))
def alias_by_recency(spark, sf):
    return _aliased(spark, sf)


@query("promote_versions", _moved("WHEN 'CANDIDATE' THEN 'PRODUCTION' WHEN 'PRODUCTION' THEN 'BACKUP'"))
def promote_versions(spark, sf):
    return lc.promote(_aliased(spark, sf))


@query("rollback_versions", _moved("WHEN 'CANDIDATE' THEN 'CANDIDATE' WHEN 'PRODUCTION' THEN 'BACKUP' WHEN 'BACKUP' THEN 'PRODUCTION'"))
def rollback_versions(spark, sf):
    return lc.roll_back(_aliased(spark, sf))


@query("versions_to_run", with_([VERSIONS], "SELECT DISTINCT model_name, model_version FROM aliased WHERE alias IN ('PRODUCTION', 'CANDIDATE')"))
def versions_to_run(spark, sf):
    return lc.versions_to_run(_aliased(spark, sf), [lc.PRODUCTION, lc.CANDIDATE])


@query(
    "active_models",
    with_(BASE, "SELECT DISTINCT 'models:/sales_' || stats_group || '/' || cust_category AS model_uri, 'sales_' || stats_group AS model_name, cust_category AS model_version FROM grouped WHERE week = 200010 AND stats_group LIKE '%stat_1%'"),
)
def active_models(spark, sf):
    uri = F.concat(F.lit("models:/sales_"), F.col(SEG), F.lit("/"), F.col("cust_category")).alias("model_uri")
    return lc.active_models(grouped(spark, sf).select(uri, "week"), 200010, "stat_1")


ROLLBACK_LIMITS = {"psi": 0.01, "kl": 0.002, "rmse_increase": 0.01, "min_samples": 500}


@query(
    "rollback_decision",
    with_(
        [*BASE,
         f"""n AS (SELECT stats_group, brand, COUNT(*) FILTER (week < {SPLIT_WEEK}) AS r, COUNT(*) FILTER (week >= {SPLIT_WEEK}) AS a FROM grouped GROUP BY 1, 2),
             s AS (SELECT stats_group, a, GREATEST(r / SUM(r) OVER w, 1e-10) AS p, GREATEST(a / SUM(a) OVER w, 1e-10) AS q FROM n WINDOW w AS (PARTITION BY stats_group)),
             d AS (SELECT stats_group, CAST(SUM(a) AS BIGINT) AS sample_count, SUM((q - p) * LN(q / p)) AS psi, SUM(q * LN(q / p)) AS kl FROM s GROUP BY 1),
             e AS (SELECT stats_group, SQRT(AVG(POWER(y - prediction, 2)) FILTER (week >= {SPLIT_WEEK})) / SQRT(AVG(POWER(y - prediction, 2)) FILTER (week < {SPLIT_WEEK})) - 1 AS rmse_increase FROM grouped GROUP BY 1),
             t AS (SELECT *, list_filter([CASE WHEN psi > 0.01 THEN printf('data_drift_psi=%.2f > 0.01', psi) END, CASE WHEN kl > 0.002 THEN printf('prediction_drift_kl=%.3f > 0.002', kl) END,
                     CASE WHEN rmse_increase > 0.01 THEN 'rmse_increase=' || CAST(CAST(ROUND(rmse_increase * 100) AS INTEGER) AS VARCHAR) || '% > 1%' END], lambda x: x IS NOT NULL) AS reasons FROM d JOIN e USING (stats_group))"""],
        """SELECT stats_group, sample_count, psi, kl, rmse_increase, CASE WHEN sample_count < 500 THEN 'skip' WHEN len(reasons) > 0 THEN 'rollback' ELSE 'none' END AS action,
             CASE WHEN sample_count < 500 THEN 'Insufficient samples (' || sample_count || ')' WHEN len(reasons) > 0 THEN array_to_string(reasons, '; ') ELSE 'All metrics within thresholds' END AS reason FROM t""",
    ),
    "psi kl rmse_increase",
)
def rollback_decision(spark, sf):
    """Decision per group from brand-share drift and the change of the forecast error, with narrow limits."""
    rows = stored_groups(spark, sf)
    is_new = F.col("week") >= SPLIT_WEEK
    shares = dr.bin_probabilities(
        rows.groupBy(is_new.alias("new"), SEG, F.col("brand").alias("bin")).agg(F.count(F.lit(1)).alias("bin_count")), ["new"], [SEG]
    )
    part = lambda new, c: F.max(F.when(F.col("new") == F.lit(new), F.col(c)))
    pq = shares.groupBy(SEG, "bin").agg(part(False, "prob").alias("p"), part(True, "prob").alias("q"), part(True, "bin_count").alias("a"))
    p, q = F.greatest("p", F.lit(dr.EPS)), F.greatest("q", F.lit(dr.EPS))
    drift = pq.groupBy(SEG).agg(F.sum("a").alias("sample_count"), F.sum((q - p) * F.ln(q / p)).alias("psi"), F.sum(q * F.ln(q / p)).alias("kl"))
    err = lambda side: F.sqrt(F.avg(F.when(side, F.pow(F.col("y") - F.col("prediction"), 2))))
    errors = rows.groupBy(SEG).agg((err(is_new) / err(~is_new) - 1).alias("rmse_increase"))
    return al.rollback_decision(drift.join(errors, SEG), ROLLBACK_LIMITS)


# --- feature store --------------------------------------------------------------------------------------------------------------

STORE = """batched AS (SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'b1' ELSE 'b2' END AS batch_id FROM orders),
hist AS (SELECT o_custkey AS customer_id, batch_id, COUNT(*) AS n_orders, SUM(o_totalprice) AS total, CAST(MAX(o_orderdate) AS DATE) AS feature_ts FROM batched GROUP BY 1, 2)"""


def _store(spark, sf, mode: str = "merge") -> str:
    """Two batches of orders through the feature store, the first one offered twice; returns its folder."""
    root = _fresh(spark, "features")
    orders = _orders(spark, sf)
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")

    def compute(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"), F.max("o_orderdate").alias("feature_ts")
        )

    for batch, rows in (("b1", orders.where(early)), ("b1", orders.where(early)), ("b2", orders.where(~early))):
        fs.run_batch(spark, rows, batch, compute, root, ["customer_id"], latest_mode=mode)
    return root


@query("feature_hist", with_([STORE], "SELECT * FROM hist"), "total")
def feature_hist(spark, sf):
    return spark.read.parquet(f"{_store(spark, sf)}/history")


@query("feature_latest", with_([STORE], "SELECT * FROM hist QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1"), "total")
def feature_latest(spark, sf):
    return fs.read_latest(spark, _store(spark, sf))


@query("feature_latest_recreated", with_([STORE], "SELECT * FROM hist WHERE batch_id = 'b2'"), "total")
def feature_latest_recreated(spark, sf):
    return fs.read_latest(spark, _store(spark, sf, "recreate"))


@query("feature_asof_batch", with_([STORE], "SELECT * FROM hist WHERE batch_id = 'b1'"), "total")
def feature_asof_batch(spark, sf):
    return fs.features_of_batch(spark.read.parquet(f"{_store(spark, sf)}/history"), "b1")


@query("feature_as_of", with_([STORE], "SELECT customer_id, feature_ts, n_orders, total, batch_id FROM hist WHERE feature_ts <= DATE '2000-06-30' QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY feature_ts DESC) = 1"), "total")
def feature_as_of(spark, sf):
    history = spark.read.parquet(f"{_store(spark, sf)}/history")
    return fs.features_as_of(history, ["customer_id"], "feature_ts", F.lit("2000-06-30").cast("date"))


@query("feature_runs", with_([STORE], "SELECT b.batch_id, 'PROCESSED' AS status, b.n AS source_rows, h.n AS feature_rows FROM (SELECT batch_id, COUNT(*) AS n FROM batched GROUP BY 1) b JOIN (SELECT batch_id, COUNT(*) AS n FROM hist GROUP BY 1) h USING (batch_id)"))
def feature_runs(spark, sf):
    return spark.read.parquet(f"{_store(spark, sf)}/runs").drop("finished_at", "folder")


# --- events: monitors, streams, reports -------------------------------------------------------------------------------------------

DAILY = f"""d AS (SELECT event_type, CAST(ts AS DATE) AS day, SUM(value) AS s, COUNT(value) AS c FROM events GROUP BY 1, 2),
means AS (SELECT event_type, day, SUM(s) OVER w / NULLIF(SUM(c) OVER w, 0) AS prediction FROM d
  WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
logged AS (SELECT e.event_type, CAST(e.ts AS DATE) AS day, e.value AS y, COALESCE(m.prediction, 0) AS prediction
  FROM events e JOIN means m ON m.event_type = e.event_type AND m.day = CAST(e.ts AS DATE)),
daily AS (SELECT day, event_type, COUNT(*) AS n_rows, ae / GREATEST(aa, 1e-10) AS wape, SQRT(se / n) AS rmse, ae / n AS mae, {F1} AS f1_binary
  FROM (SELECT day, event_type, {SUMS} FROM logged GROUP BY 1, 2) GROUP BY ALL)""".replace("COUNT(*) AS n_rows, ae", "n AS n_rows, ae").replace(
    "FROM logged GROUP BY 1, 2) GROUP BY ALL)", "FROM logged GROUP BY 1, 2))"
)


def _forecast_means(spark, sf) -> DataFrame:
    """Forecast per event type and day: the mean value of all earlier days."""
    from pyspark.sql import Window

    ev = spark.read.parquet(f"{sf}/events.parquet")
    daily = ev.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.sum("value").alias("s"), F.count("value").alias("c"))
    before = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.try_divide(F.sum("s").over(before), F.sum("c").over(before))
    return daily.select("event_type", "day", F.coalesce(mean, F.lit(0.0)).alias("prediction"))


def _logged(events: DataFrame, means: DataFrame) -> DataFrame:
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", F.col("ts").cast("date").alias("day"))
    return timed.join(means, ["event_type", "day"])


def _by_day(metrics: DataFrame) -> DataFrame:
    return metrics.select(F.col("window_start").cast("date").alias("day"), *[c for c in metrics.columns if c != "window_start"])


@query("daily_monitor", with_([DAILY], "SELECT * FROM daily"), "wape rmse mae f1_binary")
def daily_monitor(spark, sf):
    logged = _logged(spark.read.parquet(f"{sf}/events.parquet"), _forecast_means(spark, sf))
    return _by_day(mo.window_metrics(mo.windowed_sums(logged, "ts", "event_type", "value", "prediction"), "event_type"))


@query("daily_monitor_stream", with_([DAILY], "SELECT * FROM daily"), "wape rmse mae f1_binary")
def daily_monitor_stream(spark, sf):
    """The same monitor on a stream of the events file: window sums upserted per micro-batch, metrics from the sums."""
    root = _fresh(spark, "monitor")
    stream = mo.read_stream(spark, sf, "events.parquet")
    sums = mo.windowed_sums(_logged(stream, cut(_forecast_means(spark, sf))), "ts", "event_type", "value", "prediction", delay="1 day")
    # by day, so that a micro-batch reads and rewrites the days it touches only
    sums = sums.withColumn("window_day", F.to_date("window_start"))
    mo.land(sums, f"{root}/sums", f"{root}/checkpoint", ["window_start", "event_type", "window_day"], ["window_day"])
    return _by_day(mo.window_metrics(spark.read.parquet(f"{root}/sums"), "event_type"))


@query("monitor_performance", with_([DAILY], "SELECT day, event_type, rmse AS metric_value FROM daily WHERE day >= DATE '2024-01-10' AND day < DATE '2024-01-20'"), "metric_value")
def monitor_performance(spark, sf):
    logged = _logged(spark.read.parquet(f"{sf}/events.parquet"), _forecast_means(spark, sf))
    sums = mo.windowed_sums(logged, "ts", "event_type", "value", "prediction")
    return _by_day(mo.performance_between(sums, "event_type", "rmse", "2024-01-10", "2024-01-20"))


EVENT_LONG = "long_{t} AS (SELECT CAST(ts AS DATE) AS week, event_type AS stats_group, 'value' AS feature, value FROM events WHERE CAST(ts AS DATE) {c} DATE '2024-01-11')"


@query(
    "monitor_drift",
    with_(
        [EVENT_LONG.format(t="base", c="<"), EVENT_LONG.format(t="prod", c=">="), EDGES, "base AS (SELECT * FROM long_base)", "prod AS (SELECT * FROM long_prod)",
         HIST.format(t="base"), HIST.format(t="prod"), SHARES, f"j AS (SELECT week AS day, stats_group AS event_type, {JSD} AS js_distance FROM cells GROUP BY ALL)"],
        "SELECT *, CASE WHEN js_distance > 0.45 THEN 2 WHEN js_distance > 0.2 THEN 1 ELSE 0 END AS alert_level FROM j",
    ),
    "js_distance",
)
def monitor_drift(spark, sf):
    """Daily Jensen-Shannon distance of event values from the first ten days, per event type."""
    ev = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("date").alias("day"), "event_type", "value")
    start = F.lit("2024-01-11").cast("date")
    base, prod = ev.where(F.col("day") < start), ev.where(F.col("day") >= start)
    edges = hi.bin_edges(base, "event_type", [], ["value"], exact=True)
    hist = lambda part: hi.histogram(part, ["day"], "event_type", ["value"], edges)
    return dr.js_distance(hist(prod), hist(base), ["day"], ["event_type"], base_time=["day"])


@query("recent_rows", "SELECT event_id, user_id, event_type, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100", "value")
def recent_rows(spark, sf):
    """Top-k report: the 100 latest log rows."""
    return rp.recent_rows(spark.read.parquet(f"{sf}/events.parquet"), ["ts", "event_id"], 100).select("event_id", "user_id", "event_type", "ts", "value")


@query("log_status", "SELECT COUNT(*) AS total_logs, COUNT(DISTINCT event_type) AS segments, COUNT(DISTINCT user_id) AS entities, MIN(ts) AS first_log, MAX(ts) AS last_log FROM events")
def log_status(spark, sf):
    return rp.log_status(spark.read.parquet(f"{sf}/events.parquet"), "event_type", "user_id", "ts")


@query("last_periods", with_([TX, PANEL], "SELECT DISTINCT week FROM panel ORDER BY week DESC LIMIT 4"))
def last_periods(spark, sf):
    """Top-k report: the four latest weeks."""
    return rp.last_periods(weekly_sales(spark, sf), "week", 4)


@query(
    "text_keys",
    """SELECT t AS text, TRY_CAST(regexp_extract(t, '[0-9]+') AS INTEGER) AS first_number, COALESCE(TRY_CAST(t AS DOUBLE), 0) AS as_number, COUNT(*) AS row_count
         FROM (SELECT UNNEST([p_brand, CAST(p_size AS VARCHAR), CAST(p_size / 4 AS VARCHAR), regexp_extract(p_type, '[A-Z]+')]) AS t FROM part) GROUP BY 1""",
    "as_number",
)
def text_keys(spark, sf):
    """Numbers read out of texts of which some are numbers: first run of digits, and the whole as a number or else 0."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    texts = F.array("p_brand", F.col("p_size").cast("string"), (F.col("p_size") / 4).cast("string"), F.regexp_extract("p_type", "[A-Z]+", 0))
    counts = part.select(F.explode(texts).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select("text", first_number("text").alias("first_number"), number_or_zero("text").alias("as_number"), "row_count")


@query("json_params", "SELECT event_type, COUNT(*) AS row_count, SUM(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY 1")
def json_params(spark, sf):
    """Parameters kept as JSON text, read with a schema."""
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("p", F.from_json("props", "k bigint"))
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("p.k").alias("total"))
