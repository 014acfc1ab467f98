"""Registered queries: stored datasets, incremental refresh, jobs on landing tables, run times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastops.functions.calendar import local_time
from forecastops.operators import feature_store as fs
from forecastops.operators import histograms as hi
from forecastops.operators import ranking as rk
from forecastops.operators import reports as rp
from forecastops.operators import scoring as sc
from forecastops.operators import split as sp
from forecastops.operators import training as tr
from forecastops.plans import jobs
from forecastops.plans.frames import ROW_IDS, baseline, grouped, production, stored_groups
from forecastops.plans.monitoring_queries import DRIFT, HIGH, JSD, LOW, SEG
from forecastops.plans.operations_queries import STORE, _fresh, _orders
from forecastops.plans.registry import BASE, SPLIT_WEEK, query, with_
from forecastops.session import cut, store
from forecastops.sources import buckets as bu
from forecastops.sources import landing as la
from forecastops.sources import tables as tb
from forecastops.streaming import monitor as mo


def _years(spark, sf) -> DataFrame:
    return _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("year"))


ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"


@query("partition_slice", with_([ORDERS], "SELECT o_orderkey, year FROM o WHERE year IN (1996, 1999)"))
def partition_slice(spark, sf):
    """Two years of a dataset that is partitioned by year."""
    path = _fresh(spark, "slices")
    _years(spark, sf).write.partitionBy("year").parquet(path)
    return tb.read_slice(spark, path, "year", [1996, 1999]).select("o_orderkey", "year")


@query("folder_union", with_([ORDERS], "SELECT o_orderkey, year, CASE WHEN year >= 1998 THEN o_orderstatus END AS o_orderstatus FROM o"))
def folder_union(spark, sf):
    """Two folders read as one; the older lacks a column."""
    rows, paths = _years(spark, sf).select("o_orderkey", "year", "o_orderstatus"), [_fresh(spark, "older"), _fresh(spark, "newer")]
    rows.where("year < 1998").drop("o_orderstatus").write.parquet(paths[0])
    rows.where("year >= 1998").write.parquet(paths[1])
    return tb.read_many(spark, paths)


@query("snapshot_copy", with_([ORDERS], "SELECT o_orderkey, year FROM o WHERE year < 1998"))
def snapshot_copy(spark, sf):
    """A copy in the layout of its source, untouched by what is written to the source later; its table was made empty first."""
    rows = _years(spark, sf).select("o_orderkey", "year")
    source, target = _fresh(spark, "source"), _fresh(spark, "copy")
    la.create_like(spark, rows, _fresh(spark, "empty"))
    rows.where("year < 1998").write.partitionBy("year").parquet(source)
    la.snapshot(spark, source, target, ["year"])
    rows.where("year >= 1998").write.mode("append").partitionBy("year").parquet(source)
    return spark.read.schema(rows.schema).parquet(target)


@query("created_like", with_([ORDERS], "SELECT o_orderkey, o_orderstatus, year FROM o WHERE year >= 1997"))
def created_like(spark, sf):
    """A table made empty in the columns of another, then filled and read by the columns it was made with."""
    rows, path = _years(spark, sf).select("o_orderkey", "o_orderstatus", "year"), _fresh(spark, "like")
    la.create_like(spark, rows, path)
    made = spark.read.parquet(path)
    rows.where("year >= 1997").write.mode("append").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@query("segment_folders", with_([ORDERS], "SELECT o_orderkey, o_orderstatus FROM o WHERE o_orderstatus <> 'P' OR year < 1998"))
def segment_folders(spark, sf):
    """A folder per segment in two runs; the second adds only the segments the first did not write."""
    path, rows = _fresh(spark, "segments"), _years(spark, sf).select("o_orderkey", "o_orderstatus", "year")
    la.write_by_segment(spark, rows.where("o_orderstatus = 'P' and year < 1998").drop("year"), path, "o_orderstatus")
    la.write_by_segment(spark, rows.drop("year"), path, "o_orderstatus")
    return spark.read.parquet(path)


@query("monitoring_tables", with_([ORDERS], "SELECT o_orderstatus, COUNT(*) AS row_count FROM o WHERE year >= 1997 GROUP BY 1"))
def monitoring_tables(spark, sf):
    """One dataset for the monitoring rows of all segments, rewritten segment by segment."""
    path, rows = _fresh(spark, "monitoring"), _years(spark, sf)
    for part in (rows, rows.where("year >= 1997")):
        rp.monitoring_tables(part, path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("view_panel", with_([ORDERS], "SELECT year, COUNT(*) AS row_count FROM o GROUP BY 1"))
def view_panel(spark, sf):
    """A query in SQL over a view."""
    name = tb.register_view(_years(spark, sf), "orders_by_year")
    return spark.sql(f"SELECT year, COUNT(*) AS row_count FROM {name} GROUP BY year")


@query("event_local_time", "SELECT event_id, CAST(ts AS TIMESTAMP) + INTERVAL 330 MINUTE AS local_ts, CAST(CAST(ts AS TIMESTAMP) + INTERVAL 330 MINUTE AS DATE) AS local_day FROM events")
def event_local_time(spark, sf):
    """Event times in another zone, and the day they fall on there."""
    local = local_time(F.col("ts").cast("timestamp"), "+05:30")
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", local.alias("local_ts"))
    return ev.withColumn("local_day", F.col("local_ts").cast("date"))


#: The last Sunday of a month that has 31 days, as a time.
LAST_SUNDAY = "(make_date(year(t)::INTEGER, {m}, 31) - dayofweek(make_date(year(t)::INTEGER, {m}, 31))::INTEGER)::TIMESTAMP"
SUMMER = f"t >= {LAST_SUNDAY.format(m=3)} + INTERVAL 1 HOUR AND t < {LAST_SUNDAY.format(m=10)} + INTERVAL 1 HOUR"


@query("event_summer_time", f"WITH e AS (SELECT event_id, (CAST(ts AS TIMESTAMP) + INTERVAL 1 DAY * (event_id % 365)) AS t FROM events), l AS (SELECT event_id, t + CASE WHEN {SUMMER} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local_ts FROM e) SELECT event_id, local_ts, CAST(local_ts AS DATE) AS local_day FROM l")
def event_summer_time(spark, sf):
    """Times in a zone that changes its hour twice a year; events are dealt over the days of a year, so both hours occur."""
    dealt = F.col("ts").cast("timestamp") + F.make_dt_interval(days=(F.col("event_id") % 365).cast("int"))
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", local_time(dealt, "Europe/Berlin").alias("local_ts"))
    return ev.withColumn("local_day", F.col("local_ts").cast("date"))


@query("inference_clean", with_(BASE, f"SELECT customer_id, brand, week, COALESCE(avg_past_12_weeks, 0) AS avg_past_12_weeks, sum_p4w FROM grouped WHERE week >= {SPLIT_WEEK} AND NULLIF(quarter, 4) IS NOT NULL"), "avg_past_12_weeks sum_p4w")
def inference_clean(spark, sf):
    """Scoring rows from a week on that have all they need, absent features as 0."""
    rows = grouped(spark, sf).withColumn("quarter", F.nullif("quarter", F.lit(4)))
    kept = sp.fill_features(sp.clean_inference(sp.since(rows, "week", F.lit(SPLIT_WEEK)), [*ROW_IDS, "quarter"]), ["avg_past_12_weeks"])
    return kept.select(*ROW_IDS, "avg_past_12_weeks", "sum_p4w")


@query("approximate_quantiles", with_(BASE, "SELECT stats_group, true AS within_error FROM grouped GROUP BY 1"))
def approximate_quantiles(spark, sf):
    """Sketched quantiles against exact ranks: each lies at most one per cent of the group's rows off."""
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    rows = stored_groups(spark, sf)
    sketch = rk.quantiles(rows, [SEG], "sum_p4w", probs, exact=False, accuracy=1000)
    points = sketch.select(SEG, F.posexplode("qs").alias("k", "q"))
    ranks = rows.join(F.broadcast(points), SEG).groupBy(SEG, "k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("sum_p4w") < F.col("q")).alias("below"), F.count_if(F.col("sum_p4w") <= F.col("q")).alias("upto")
    )
    wanted = F.get(F.array(*[F.lit(p) for p in probs]), F.col("k")) * F.col("n")
    slack = 0.01 * F.col("n") + 1
    return ranks.groupBy(SEG).agg(F.bool_and((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("within_error"))


@query("column_classes", with_(BASE, "SELECT * FROM (VALUES ('brand', 'categorical'), ('cust_category', 'categorical'), ('customer_id', 'excluded'), ('quarter', 'categorical'), ('sum_p4w', 'numeric'), ('y', 'numeric')) AS v(column_name, class), (SELECT COUNT(*) AS row_count FROM grouped) AS n"))
def column_classes(spark, sf):
    """Columns by use, with the rows they were told from."""
    rows = grouped(spark, sf).select("customer_id", "brand", "y", "sum_p4w", "quarter", "cust_category")
    classes = hi.classify_columns(rows, ["CUSTOMER_ID"], ["quarter"])
    listed = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("class")) for k, cs in classes.items() for c in cs]
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.explode(F.array(*listed)).alias("c"), "row_count").select("c.*", "row_count")


@query("feature_late_rows", with_([STORE], "SELECT * FROM hist WHERE batch_id = 'b1'"), "total")
def feature_late_rows(spark, sf):
    """A batch whose rows arrive in two calls, the second after the batch was processed: none is lost."""
    root, early = _fresh(spark, "late"), _orders(spark, sf).where("o_orderdate < DATE'1998-01-01'")

    def compute(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"), F.max("o_orderdate").alias("feature_ts")
        )

    for part in ("o_custkey % 2 = 0", "o_custkey % 2 = 1", "true"):
        fs.run_batch(spark, early.where(part), "b1", compute, root, ["customer_id"])
    return spark.read.parquet(f"{root}/history")


@query("refreshed_view", "SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS total, CAST(o_custkey % 8 AS INTEGER) AS bucket FROM orders GROUP BY 1", "total")
def refreshed_view(spark, sf):
    """A view brought up to date by two runs of a stream over arriving files; the second finds new orders of known customers.

    Files lie in folders by customer bucket, and a run reads the folders of the buckets that got rows, not the whole history.
    """
    inbox, path, marks = _fresh(spark, "inbox"), _fresh(spark, "view"), _fresh(spark, "marks")
    orders = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", (F.col("o_custkey") % 8).cast("int").alias("bucket"))

    def recompute(arrived: DataFrame) -> DataFrame:
        touched = [r.bucket for r in arrived.select("bucket").distinct().collect()]  # eight at most
        history = spark.read.schema(orders.schema).parquet(inbox).where(F.col("bucket").isin(touched))
        history = history.join(arrived.select("o_custkey").distinct(), "o_custkey", "left_semi")
        return history.groupBy("o_custkey", "bucket").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))

    for part in ("o_orderkey % 3 = 0", "o_orderkey % 3 > 0"):
        orders.where(part).write.mode("append").partitionBy("bucket").parquet(inbox)
        arriving = spark.readStream.schema(orders.schema).parquet(inbox)
        mo.refresh(spark, arriving, recompute, path, marks, ["o_custkey", "bucket"], ["bucket"])
    return spark.read.parquet(path).select("o_custkey", "n_orders", "total", "bucket")


@query("unmonitored_pairs", with_(BASE, f"SELECT p.brand, f AS feature, CASE WHEN p.brand IN (SELECT brand FROM grouped WHERE week < {SPLIT_WEEK} AND week_of_year < 6) THEN 'no edges' ELSE 'new segment' END AS reason FROM (SELECT DISTINCT brand FROM grouped WHERE week >= {SPLIT_WEEK}) p, (VALUES ('quarter'), ('sum_p4w')) AS v(f) WHERE f = 'quarter' OR p.brand NOT IN (SELECT brand FROM grouped WHERE week < {SPLIT_WEEK} AND week_of_year < 6)"))
def unmonitored_pairs(spark, sf):
    """Segments and features without bins: the baseline here has the first weeks of years only, so no second quarter."""
    rows = stored_groups(spark, sf)
    base = baseline(rows).where("week_of_year < 6")
    return hi.unmonitored(production(rows), "brand", ["quarter", "sum_p4w"], hi.bin_edges(base, "brand", ["quarter"], ["sum_p4w"], exact=True))


VERSIONS = ("models:/linear/1", "models:/linear/2")


def _landed(spark, sf, drift: bool) -> str:
    """Score, baselines and drift or performance of two versions on landing tables, each job run twice; returns their folder.

    Version names and segment names hold slashes. A second breakdown column comes with the second run of the performance job.
    """
    root = _fresh(spark, "landing")
    rows = store(grouped(spark, sf).withColumn(SEG, F.concat(F.lit("a/"), F.col(SEG))))
    columns, keys, unit = ["w_m1_total"], ROW_IDS, "UNIT"
    models = tr.grouped_fit(rows, SEG, columns, "y")
    models = cut(tr.models_frame(spark, models, "linear", VERSIONS[0]).unionByName(tr.models_frame(spark, models, "linear", VERSIONS[1])))
    features = rows.drop("prediction")
    for segs in ([SEG], [SEG] if drift else [SEG, "cust_category"]):
        jobs.score(spark, root, features, models, "linear", SEG, columns, ["customer_id", "brand"], unit=unit)
        if drift:
            for v in VERSIONS:
                jobs.drift_baseline(spark, root, baseline(features), "linear", v, segs, LOW, HIGH, exact=True)
            jobs.data_drift(spark, root, production(features), "linear", segs, [*LOW, *HIGH], unit=unit, min_week=SPLIT_WEEK)
            continue
        view = jobs.read(spark, root, "predictions")
        view = view.select("model_version", "week", F.col("entity_map")["customer_id"].cast("int").alias("customer_id"), F.col("entity_map")["brand"].alias("brand"), "prediction")
        view = store(view.join(rows.select(*ROW_IDS, SEG, "cust_category"), ROW_IDS))
        actuals = rows.select(*ROW_IDS, "y")
        jobs.performance_baseline(spark, root, baseline(view), actuals, "linear", segs, "y", keys, unit=unit)
        jobs.performance(spark, root, production(view), actuals, "linear", segs, "y", keys, unit=unit, min_week=SPLIT_WEEK)
    return root


VERSION_SQL = " UNION ALL ".join(f"SELECT '{v}' AS model_version" for v in VERSIONS)


@query(
    "versioned_drift",
    with_(
        [*DRIFT, f"j AS (SELECT week, stats_group, feature, {JSD} AS js_distance FROM cells WHERE feature <> 'prediction' GROUP BY ALL)"],
        f"SELECT model_version, week, 'a/' || stats_group AS segment, feature, js_distance FROM j, ({VERSION_SQL})",
    ),
    "js_distance",
)
def versioned_drift(spark, sf):
    """Drift landed by the jobs for two versions, equal to that of plain names."""
    landed = jobs.read(spark, _landed(spark, sf, True), "drift").where((F.col("metric_col") == jobs.JS) & (F.col("aggregated_col") == SEG) & F.col("metric_value").isNotNull())
    return landed.select("model_version", "week", F.col("aggregated_value").alias("segment"), F.col("entity_map")["feature_name"].alias("feature"), F.col("metric_value").alias("js_distance"))


@query(
    "performance_second_dimension",
    with_(
        [*BASE, "scored AS (SELECT *, intercept + slope * w_m1_total AS yhat FROM grouped JOIN (SELECT stats_group, regr_slope(y, w_m1_total) AS slope, regr_intercept(y, w_m1_total) AS intercept FROM grouped GROUP BY 1) USING (stats_group))"],
        f"SELECT model_version, week, cust_category, SUM(ABS(y - yhat)) / SUM(ABS(y)) AS wape FROM scored, ({VERSION_SQL}) WHERE week >= {SPLIT_WEEK} GROUP BY 1, 2, 3",
    ),
    "wape",
)
def performance_second_dimension(spark, sf):
    """Errors by a breakdown column that was added after the first had landed."""
    landed = jobs.read(spark, _landed(spark, sf, False), "performance").where("metric_col = 'wape' and aggregated_col = 'cust_category'")
    kept = landed.where(F.col("aggregated_value").isin("VALUE", "REGULAR"))
    return kept.select("model_version", "week", F.col("aggregated_value").alias("cust_category"), F.col("metric_value").alias("wape"))


@query(
    "prediction_drift_job",
    with_(
        [*DRIFT, f"j AS (SELECT week, stats_group, {JSD} AS js_distance FROM cells WHERE feature = 'prediction' GROUP BY ALL)"],
        f"SELECT model_version, week, stats_group AS segment, js_distance FROM j, ({VERSION_SQL})",
    ),
    "js_distance",
)
def prediction_drift_job(spark, sf):
    """Score, prediction baseline and prediction drift of two versions on landing tables, the last two run twice."""
    root = _fresh(spark, "landing")
    rows = store(grouped(spark, sf))
    # models that repeat last week's sales
    models = rows.groupBy(SEG).agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"intercept": F.lit(0.0), "coefficients": F.array(F.lit(1.0)), "train_rmse": F.lit(0.0)})
    models = cut(tr.models_frame(spark, models, "naive", VERSIONS[0]).unionByName(tr.models_frame(spark, models, "naive", VERSIONS[1])))
    jobs.score(spark, root, rows.drop("prediction"), models, "naive", SEG, ["w_m1_total"], ["customer_id", "brand"], unit="UNIT")
    view = store(sc.prediction_view(jobs.read(spark, root, "predictions"), {"customer_id": "int", "brand": "string"}, SEG))
    for _ in range(2):
        for v in VERSIONS:
            jobs.drift_baseline(spark, root, baseline(view.where(F.col("model_version") == v)), "naive", v, [SEG], [], ["prediction"], predictions=True, exact=True)
        jobs.prediction_drift(spark, root, "naive", [SEG], production(view), unit="UNIT", min_week=SPLIT_WEEK)
    landed = jobs.read(spark, root, "prediction_drift").where((F.col("metric_col") == jobs.JS) & F.col("metric_value").isNotNull())
    return landed.select("model_version", "week", F.col("aggregated_value").alias("segment"), F.col("metric_value").alias("js_distance"))


ROUTES = {
    "group_stat_0": lambda x: x["w_m1_total"],
    "group_stat_1": lambda x: x["sum_past_4_weeks"] / 4,
    "group_stat_2": lambda x: x["avg_past_12_weeks"],
    "group_stat_3": lambda x: 0.5 * x["w_m1_total"] + 0.125 * x["sum_past_4_weeks"],
}


@query(
    "routed_score",
    with_(
        BASE,
        """SELECT customer_id, brand, week, stats_group, CASE stats_group WHEN 'group_stat_0' THEN w_m1_total WHEN 'group_stat_1' THEN sum_past_4_weeks / 4 WHEN 'group_stat_2' THEN avg_past_12_weeks
             ELSE 0.5::DOUBLE * w_m1_total + 0.125::DOUBLE * sum_past_4_weeks END AS prediction FROM grouped""",
    ),
    "prediction",
)
def routed_score(spark, sf):
    """An ensemble of one Python model per group, each batch of rows scored where it is."""
    rows = grouped(spark, sf).drop("prediction")
    return sc.routed_score(rows, SEG, ROUTES, ["w_m1_total", "sum_past_4_weeks", "avg_past_12_weeks"], ROW_IDS)


@query("bucketed_actuals", with_(BASE, f"SELECT customer_id, brand, week, prediction, y FROM grouped WHERE week >= {SPLIT_WEEK}"), "prediction y")
def bucketed_actuals(spark, sf):
    """Predictions and actual sales as bucketed tables, joined without a shuffle."""
    rows = stored_groups(spark, sf)
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("predictions", "actuals")]
    bu.write_bucketed(production(rows).select(*ROW_IDS, "prediction"), names[0], ROW_IDS, 8)
    bu.write_bucketed(rows.select(*ROW_IDS, "y"), names[1], ROW_IDS, 8)
    return bu.bucket_join(spark, *names, ROW_IDS)
