"""Registered queries: segmentation, data quality, cleaning and splits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from forecastops.operators import quality as qa
from forecastops.operators import segments as sg
from forecastops.operators import split as sp
from forecastops.plans.feature_queries import INFERENCE_FROM, ROLLUP
from forecastops.plans.frames import ROW_IDS, baseline, features, grouped, last_day, production, stored_groups, weekly_sales
from forecastops.plans.registry import BASE, BITS, FEATURES, LAST_DAY, PANEL, SIX, SPLIT_WEEK, TX, query, with_
from forecastops.operators.features import weekly_rollup
from forecastops.session import store
from forecastops.sources.tables import customers, products, transactions

PATTERNED = [TX, PANEL, FEATURES, f'pat AS (SELECT *, {BITS} AS "group" FROM features)']


@query(
    "pattern_group",
    with_(PATTERNED, """SELECT customer_id, brand, week, "group", sum_p4w FROM pat WHERE "group" <> '0000'"""),
    "sum_p4w",
)
def pattern_group(spark, sf):
    return sg.pattern_group(features(spark, sf)).select(*ROW_IDS, "group", "sum_p4w")


QUARTILES = """quart AS (SELECT "group" AS g, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS q2, quantile_cont(y, 0.75) AS q3
  FROM {source} GROUP BY 1),
ruled AS (SELECT g, CASE WHEN q1 = 0 AND q2 = 0 AND q3 = 0 THEN 'group_stat_0' WHEN q1 = 0 AND q2 = 0 AND q3 > 0 THEN 'group_stat_1'
  WHEN q1 = 0 AND q2 > 0 AND q3 > 0 THEN 'group_stat_2' WHEN q1 > 0 AND q2 > 0 AND q3 > 0 THEN 'group_stat_3' END AS stats_group FROM quart)"""
# weekly units over the panel's lower quartile, so that zero targets occur
SURPLUS = """surplus AS (SELECT * REPLACE (GREATEST(y - 20 * (4 - LENGTH(REPLACE("group", '0', ''))) , 0) AS y) FROM pat WHERE "group" <> '0000')"""


@query(
    "stats_group_quartile",
    with_([*PATTERNED, SURPLUS, QUARTILES.format(source="surplus")], """SELECT customer_id, brand, week, "group", r.stats_group, y FROM surplus s JOIN ruled r ON s."group" = r.g"""),
    "y",
)
def stats_group_quartile(spark, sf):
    """Quartile rule on a target lowered by pattern, so that all four groups can occur."""
    rows = store(sg.pattern_group(features(spark, sf)))
    idle = 4 - F.length(F.replace("group", F.lit("0"), F.lit("")))
    lowered = rows.withColumn("y", F.greatest(F.col("y") - 20 * idle, F.lit(0.0)))
    return sg.stats_group_by_quartile(lowered, "y", exact=True).select(*ROW_IDS, "group", "stats_group", "y")


@query("stats_group_activity", with_(BASE, 'SELECT customer_id, brand, week, "group", stats_group FROM grouped'))
def stats_group_activity(spark, sf):
    return grouped(spark, sf).select(*ROW_IDS, "group", "stats_group")


NTILED = """ntiled AS (SELECT *, NTILE(4) OVER (PARTITION BY stats_group ORDER BY sum_p4w, customer_id, brand, week) AS pg FROM grouped)"""


@query(
    "ntile_group",
    with_([*BASE, NTILED], "SELECT customer_id, brand, week, sum_p4w, CAST(pg AS INTEGER) AS percentile_group, stats_group || '_' || pg AS stats_ntile_group FROM ntiled"),
    "sum_p4w",
)
def ntile_group(spark, sf):
    return sg.ntile_group(grouped(spark, sf), "sum_p4w", ROW_IDS).select(*ROW_IDS, "sum_p4w", "percentile_group", "stats_ntile_group")


DESCRIPTIONS = "CASE segment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sg.SEGMENT_TEXT.items()) + " END AS segment_description"


@query("six_way_segments", with_([TX, LAST_DAY, SIX], f"SELECT *, {DESCRIPTIONS} FROM six"), "total_units_4w")
def six_way_segments(spark, sf):
    tx = transactions(spark, sf)
    return sg.six_way_segments(tx, customers(spark, sf), last_day(spark, sf))


@query(
    "segment_share",
    with_([TX, LAST_DAY, SIX], "SELECT segment, COUNT(*) AS row_count, ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percentage FROM six GROUP BY 1"),
    "percentage",
)
def segment_share(spark, sf):
    tx = transactions(spark, sf)
    return sg.share_of_total(sg.six_way_segments(tx, customers(spark, sf), last_day(spark, sf)), ["segment"])


@query(
    "pattern_support",
    with_([TX, LAST_DAY, SIX], "SELECT segment, purchase_pattern, COUNT(*) AS customer_count FROM six GROUP BY 1, 2 HAVING COUNT(*) >= 5"),
)
def pattern_support(spark, sf):
    tx = transactions(spark, sf)
    return sg.pattern_support(sg.six_way_segments(tx, customers(spark, sf), last_day(spark, sf)), "segment", "purchase_pattern")


@query(
    "customer_category",
    """SELECT p_type AS category, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size > 40 THEN 'large' ELSE 'other' END AS cust_category,
         COUNT(*) AS row_count FROM part GROUP BY 1, 2""",
)
def customer_category(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").withColumns(
        {"is_small": (F.col("p_size") <= 10).cast("int"), "is_large": (F.col("p_size") > 40).cast("int")}
    )
    label = sg.customer_category([("is_small", "small"), ("is_large", "large")], "other")
    return part.groupBy(F.col("p_type").alias("category"), label.alias("cust_category")).agg(F.count(F.lit(1)).alias("row_count"))


# --- quality ------------------------------------------------------------------------------------------------------------


@query(
    "null_profile",
    with_(BASE, "SELECT COUNT(*) AS total_rows, COUNT(*) - COUNT(NULLIF(w_m1_total, 0)) AS null_w_m1_total, COUNT(*) - COUNT(NULLIF(w_m4_total, 0)) AS null_w_m4_total, 0::BIGINT AS null_week FROM grouped"),
)
def null_profile(spark, sf):
    """Zeros of two lags read as nulls."""
    rows = grouped(spark, sf).withColumns({c: F.nullif(c, F.lit(0.0)) for c in ("w_m1_total", "w_m4_total")})
    return qa.null_profile(rows, ["w_m1_total", "w_m4_total", "week"])


@query(
    "target_distribution",
    with_(
        [TX, PANEL],
        """SELECT UNNEST(['n', 'mean', 'sd', 'p0', 'p25', 'p50', 'p75', 'p100']) AS statistic,
             UNNEST([CAST(COUNT(y) AS DOUBLE), AVG(y), STDDEV_SAMP(y), MIN(y), quantile_cont(y, 0.25), quantile_cont(y, 0.5), quantile_cont(y, 0.75), MAX(y)]) AS value FROM panel""",
    ),
    "value",
)
def target_distribution(spark, sf):
    return qa.target_distribution(store(weekly_sales(spark, sf)), "y")


@query(
    "revenue_quantiles",
    with_([TX], "SELECT quantile_cont(revenue, 0.01) AS q01, quantile_cont(revenue, 0.5) AS q50, quantile_cont(revenue, 0.99) AS q99 FROM tx"),
    "q01 q50 q99",
)
def revenue_quantiles(spark, sf):
    """Exact quantiles of a column with very many distinct values, found by ranks instead of one aggregate buffer."""
    from forecastops.operators.ranking import quantiles

    q = quantiles(transactions(spark, sf), [], "revenue", [0.01, 0.5, 0.99], value_pairs=1000)
    return q.select(*[F.get("qs", F.lit(i)).alias(n) for i, n in enumerate(("q01", "q50", "q99"))])


@query(
    "outliers_3sigma",
    with_(
        [TX, PANEL],
        """SELECT CASE WHEN z < 0 THEN 'below' ELSE 'above' END AS side, COUNT(*) AS n, COUNT(*) / MAX(total) AS share, MIN(ABS(z)) AS nearest, MAX(ABS(z)) AS farthest
           FROM (SELECT (y - AVG(y) OVER ()) / STDDEV_SAMP(y) OVER () AS z, COUNT(*) OVER () AS total FROM panel) WHERE ABS(z) > 3 GROUP BY 1""",
    ),
    "share nearest farthest",
)
def outliers_3sigma(spark, sf):
    return qa.outliers_3sigma(store(weekly_sales(spark, sf)), "y")


@query(
    "group_distribution",
    with_([*BASE], "SELECT stats_group, COUNT(*) / SUM(COUNT(*)) OVER () AS share, COUNT(*) / COUNT(DISTINCT customer_id) AS rows_per_entity, AVG(y) AS mean, STDDEV_SAMP(y) AS sd FROM grouped GROUP BY 1"),
    "share rows_per_entity mean sd",
)
def group_distribution(spark, sf):
    return qa.group_distribution(stored_groups(spark, sf), "stats_group", "customer_id", "y")


@query(
    "group_check",
    with_(
        [*BASE, NTILED],
        """SELECT COUNT(*) AS group_count, MIN(n) AS min_records, MAX(n) AS max_records, COUNT(*) = 16 AS groups_as_expected,
             MIN(n) >= 100 AS all_groups_sufficient
           FROM (SELECT stats_group || pg AS g, COUNT(*) AS n FROM ntiled GROUP BY 1)""",
    ),
)
def group_check(spark, sf):
    return qa.group_check(sg.ntile_group(grouped(spark, sf), "sum_p4w", ROW_IDS), "stats_ntile_group")


@query(
    "dataset_comparison",
    with_(
        BASE,
        f"""SELECT d AS dataset, COUNT(*) AS total_rows, COUNT(DISTINCT customer_id) AS unique_entities, COUNT(DISTINCT week) AS unique_weeks
           FROM (SELECT 'all' AS d, customer_id, week FROM features UNION ALL SELECT 'train', customer_id, week FROM grouped WHERE week < {SPLIT_WEEK}
                 UNION ALL SELECT 'inference', customer_id, week FROM grouped WHERE week >= {SPLIT_WEEK}) GROUP BY 1""",
    ),
)
def dataset_comparison(spark, sf):
    rows = stored_groups(spark, sf)
    sets = {"all": features(spark, sf), "train": baseline(rows), "inference": production(rows)}
    return qa.dataset_comparison(sets, "customer_id", "week")


@query(
    "date_ranges",
    with_(
        [TX],
        f"""SELECT tx_date >= DATE '{INFERENCE_FROM}' AS part, COUNT(*) AS n_rows, MIN(tx_date) AS first_day, MAX(tx_date) AS last_day,
             COUNT(DISTINCT tx_date) AS days_present, MAX(tx_date) - MIN(tx_date) + 1 - COUNT(DISTINCT tx_date) AS days_absent FROM tx GROUP BY 1""",
    ),
)
def date_ranges(spark, sf):
    """Coverage before and from the first day that is forecast."""
    return qa.date_ranges(transactions(spark, sf), F.col("tx_date") >= F.lit(INFERENCE_FROM).cast("date"), "tx_date")


@query(
    "sufficiency",
    with_(
        BASE,
        """SELECT brand, COUNT(*) AS records, COUNT(DISTINCT customer_id) AS entities, COUNT(DISTINCT week) AS weeks,
             CASE WHEN COUNT(*) >= 100 AND COUNT(DISTINCT customer_id) >= 10 THEN 'SUFFICIENT'
               WHEN COUNT(*) >= 50 AND COUNT(DISTINCT customer_id) >= 5 THEN 'MARGINAL' ELSE 'INSUFFICIENT' END AS data_quality
           FROM grouped GROUP BY 1""",
    ),
)
def sufficiency(spark, sf):
    return qa.sufficiency(grouped(spark, sf), "brand", "customer_id", "week")


@query(
    "schema_compat",
    with_(
        BASE,
        f"""SELECT 'sum_p4w' AS column_name, COUNT(sum_p4w) FILTER (week < {SPLIT_WEEK}) AS train_values, COUNT(sum_p4w) FILTER (week >= {SPLIT_WEEK}) AS inference_values, 'match' AS status FROM grouped
           UNION ALL SELECT 'w_m1_total', COUNT(*) FILTER (week < {SPLIT_WEEK}), COUNT(*) FILTER (week >= {SPLIT_WEEK}), 'match' FROM grouped
           UNION ALL SELECT 'avg_past_12_weeks', COUNT(*) FILTER (week < {SPLIT_WEEK}), NULL, 'missing_in_inference' FROM grouped
           UNION ALL SELECT 'quarter', NULL, COUNT(*) FILTER (week >= {SPLIT_WEEK}), 'missing_in_train' FROM grouped""",
    ),
)
def schema_compat(spark, sf):
    rows = stored_groups(spark, sf)
    train = baseline(rows).select(*ROW_IDS, "y", "sum_p4w", "w_m1_total", "avg_past_12_weeks")
    inference = production(rows).select(*ROW_IDS, "sum_p4w", "w_m1_total", "quarter")
    return qa.schema_compat(train, inference, [*ROW_IDS, "Y"])


@query(
    "category_rollup",
    with_(
        [TX, "sold AS (SELECT product_id, SUM(units) AS u, SUM(revenue) AS r FROM tx GROUP BY 1)"],
        """SELECT p_type AS category, COUNT(*) AS listed, COUNT(u) AS sold, (MIN(p_retailprice) + MAX(p_retailprice)) / 2 AS middle_price,
             COALESCE(SUM(u), 0) AS units, SUM(r) / SUM(u) AS revenue_per_unit FROM part LEFT JOIN sold ON p_partkey = product_id GROUP BY 1""",
    ),
    "middle_price units revenue_per_unit",
)
def category_rollup(spark, sf):
    return qa.category_rollup(transactions(spark, sf), products(spark, sf))


@query(
    "yearly_summary",
    with_(
        [TX, ROLLUP, "sums AS (SELECT week_start_date AS w, COUNT(*) AS n, SUM(weekly_sales_units) AS u FROM rollup GROUP BY 1)"],
        """SELECT CAST(year(w) AS INTEGER) AS year, SUM(n)::BIGINT AS customer_weeks, SUM(u) / SUM(n) AS units_per_customer_week,
             arg_max(w, (u, -(w - DATE '1970-01-01'))) AS top_week FROM sums GROUP BY 1""",
    ),
    "units_per_customer_week",
)
def yearly_summary(spark, sf):
    return qa.yearly_summary(weekly_rollup(transactions(spark, sf), INFERENCE_FROM))


@query(
    "row_counts",
    "SELECT 'customers' AS dataset, COUNT(*) AS row_count FROM customer UNION ALL SELECT 'products', COUNT(*) FROM part UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'lines', COUNT(*) FROM lineitem",
)
def row_counts(spark, sf):
    from forecastops.sources.landing import landing_summary

    names = {"customers": "customer", "products": "part", "orders": "orders", "lines": "lineitem"}
    return landing_summary({k: spark.read.parquet(f"{sf}/{v}.parquet") for k, v in names.items()})


@query(
    "running_share",
    with_(
        BASE,
        """SELECT stats_group, week, n AS weekly_rows, SUM(n) OVER (PARTITION BY stats_group ORDER BY week)::BIGINT AS running_total,
             SUM(n) OVER (PARTITION BY stats_group)::BIGINT AS total_rows FROM (SELECT stats_group, week, COUNT(*) AS n FROM grouped GROUP BY 1, 2)""",
    ),
)
def running_share(spark, sf):
    """Running and total row counts per group, over weekly counts."""
    weekly = grouped(spark, sf).groupBy("stats_group", "week").agg(F.count(F.lit(1)).alias("weekly_rows"))
    w = Window.partitionBy("stats_group")
    running = F.sum("weekly_rows").over(w.orderBy("week").rowsBetween(Window.unboundedPreceding, 0))
    return weekly.withColumns({"running_total": running, "total_rows": F.sum("weekly_rows").over(w)})


# --- cleaning and splits --------------------------------------------------------------------------------------------------

CLEANED = "cleaned AS (SELECT * FROM grouped WHERE y >= 0 AND y <= (SELECT quantile_cont(y, 0.99) FROM grouped))"
CUTS = """weekly_n AS (SELECT stats_group, week, COUNT(*) AS n FROM cleaned GROUP BY 1, 2),
cuts AS (SELECT stats_group, CAST(MIN(week) AS INTEGER) AS cutoff_week FROM (
  SELECT stats_group, week, CAST(SUM(n) OVER (PARTITION BY stats_group ORDER BY week) AS DOUBLE) / SUM(n) OVER (PARTITION BY stats_group) AS s FROM weekly_n)
  WHERE s >= CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE) GROUP BY 1)"""


@query("clean_p99", with_([*BASE, CLEANED], "SELECT customer_id, brand, week, stats_group, y FROM cleaned"), "y")
def clean_p99(spark, sf):
    return sp.clean(stored_groups(spark, sf), ROW_IDS, "y").select(*ROW_IDS, "stats_group", "y")


@query(
    "clip_p99",
    with_(BASE, "SELECT customer_id, brand, week, LEAST(y, (SELECT quantile_cont(y, 0.99) FROM grouped)) AS y FROM grouped WHERE y >= 0"),
    "y",
)
def clip_p99(spark, sf):
    return sp.clean(stored_groups(spark, sf), ROW_IDS, "y", mode="clip").select(*ROW_IDS, "y")


@query("holdout_thresholds", with_([*BASE, CLEANED, CUTS], "SELECT * FROM cuts"))
def holdout_thresholds(spark, sf):
    return sp.holdout_thresholds(sp.clean(stored_groups(spark, sf), ROW_IDS, "y"), "stats_group", "week")


@query(
    "train_split",
    with_([*BASE, CLEANED, CUTS], "SELECT customer_id, brand, week, stats_group, y FROM cleaned JOIN cuts USING (stats_group) WHERE week <= cutoff_week"),
    "y",
)
def train_split(spark, sf):
    train, _ = sp.clean_and_holdout(stored_groups(spark, sf), "stats_group", "week", ["customer_id", "brand"], "y")
    return train.select(*ROW_IDS, "stats_group", "y")


@query(
    "holdout_split",
    with_([*BASE, CLEANED, CUTS], "SELECT customer_id, brand, week, stats_group, y FROM cleaned JOIN cuts USING (stats_group) WHERE week > cutoff_week"),
    "y",
)
def holdout_split(spark, sf):
    _, holdout = sp.clean_and_holdout(stored_groups(spark, sf), "stats_group", "week", ["customer_id", "brand"], "y")
    return holdout.select(*ROW_IDS, "stats_group", "y")


RANKED = """placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY stats_group ORDER BY week, customer_id, brand) AS rn,
  COUNT(*) OVER (PARTITION BY stats_group) AS n FROM grouped)"""


@query(
    "temporal_split_8020",
    with_([*BASE, RANKED], "SELECT customer_id, brand, week, stats_group, rn > FLOOR(n * CAST(0.8 AS DOUBLE)) AS is_test FROM placed"),
)
def temporal_split_8020(spark, sf):
    out = sp.temporal_split(stored_groups(spark, sf), "stats_group", "week", ["customer_id", "brand"])
    return out.select(*ROW_IDS, "stats_group", "is_test")


BUCKET = "CAST(('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|' || brand || '|' || CAST(week AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)"


@query("random_split_8020", with_([TX, PANEL], f"SELECT customer_id, brand, week, {BUCKET} < 20 AS is_test FROM panel"))
def random_split_8020(spark, sf):
    return sp.random_split(weekly_sales(spark, sf), ROW_IDS).select(*ROW_IDS, "is_test")


@query("keyed_sample", with_([TX, PANEL], f"SELECT customer_id, brand, week, y FROM panel WHERE {BUCKET} < 20"), "y")
def keyed_sample(spark, sf):
    """Sampling operator: 20 percent of the rows by key hash."""
    return sp.keyed_sample(weekly_sales(spark, sf), ROW_IDS, 20)
