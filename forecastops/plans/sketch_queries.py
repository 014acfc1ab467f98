"""Registered queries: stored sketches and two-sample tests on values."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastops.operators import samples as sa
from forecastops.operators import sketches as sk
from forecastops.operators.histograms import unpivot_features
from forecastops.plans.frames import stored_groups
from forecastops.plans.registry import BASE, SPLIT_WEEK, query, with_
from forecastops.session import cut, lookup, shared_folder
from forecastops.sources.tables import read_or_empty

SEG = "stats_group"
COLUMNS = ["w_m1_total", "sum_past_4_weeks", "avg_past_12_weeks"]
BINS = 20


def _landed(spark, rows: DataFrame, make) -> DataFrame:
    """Sketches of all weeks, the baseline's first and the others by a second run."""
    path = f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    for part in (rows.where(F.col("week") < SPLIT_WEEK), rows):
        sk.add_weeks(spark, path, part, "week", make)
    return read_or_empty(spark, path, make(rows).schema)


LONG = f"long AS (UNPIVOT (SELECT stats_group, week, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in COLUMNS)} FROM grouped) ON {', '.join(COLUMNS)} INTO NAME feature VALUE value)"


@query(
    "sketched_edges",
    with_([*BASE, LONG], "SELECT stats_group, feature, COUNT(*) AS n, TRUE AS within FROM long GROUP BY 1, 2 HAVING MIN(value) < MAX(value)"),
)
def sketched_edges(spark, sf):
    """Edges of 20 bins from merged weekly sketches; ``within`` tells that every edge's rank is as near as promised."""
    rows = stored_groups(spark, sf).select(SEG, "week", *COLUMNS)
    stored = _landed(spark, rows, lambda part: sk.quantile_sketches(part, "week", SEG, COLUMNS))
    probs = [i / BINS for i in range(1, BINS)]
    asked = F.arrays_zip("qs", F.array(*[F.lit(p) for p in probs]).alias("p"))
    edges = sk.sketched_quantiles(stored, [SEG, "feature"], probs).where("low < high").select(F.col(SEG).alias("s"), F.col("feature").alias("f"), asked.alias("asked"))
    long = unpivot_features(rows, [SEG], COLUMNS)
    met = long.join(lookup(edges), (F.col(SEG) == F.col("s")) & (F.col("feature") == F.col("f"))).select(SEG, "feature", "value", F.posexplode("asked").alias("i", "e"))
    ranks = met.groupBy(SEG, "feature", "i").agg(F.count(F.lit(1)).alias("n"), F.max("e.p").alias("p"), F.count_if(F.col("value") < F.col("e.qs")).alias("below"), F.count_if(F.col("value") <= F.col("e.qs")).alias("upto"))
    off = F.greatest(F.col("below") / F.col("n") - F.col("p"), F.col("p") - F.col("upto") / F.col("n"))
    return ranks.groupBy(SEG, "feature").agg(F.max("n").alias("n"), (F.max(off) <= sk.RANK_ERROR).alias("within"))


@query(
    "distinct_rollup",
    with_(
        BASE,
        """SELECT stats_group, week, CAST(0 AS INTEGER) AS level, COUNT(*) AS n_rows, COUNT(DISTINCT customer_id || '|' || brand) AS n_distinct FROM grouped GROUP BY stats_group, week
           UNION ALL SELECT stats_group, NULL, 1, COUNT(*), COUNT(DISTINCT customer_id || '|' || brand) FROM grouped GROUP BY stats_group
           UNION ALL SELECT NULL, NULL, 2, COUNT(*), COUNT(DISTINCT customer_id || '|' || brand) FROM grouped""",
    ),
)
def distinct_rollup(spark, sf):
    """Distinct series per week and group, per group and in all, from stored weekly sketches."""
    rows = stored_groups(spark, sf).select(SEG, "week", F.concat_ws("|", "customer_id", "brand").alias("series"))
    stored = _landed(spark, rows, lambda part: sk.distinct_sketches(part, "week", SEG, "series"))
    return sk.distinct_levels(stored, [[SEG, "week"], [SEG], []])


SAMPLES = [
    *BASE,
    LONG,
    f"counts AS (SELECT stats_group, feature, value, COUNT(*) FILTER (week < {SPLIT_WEEK}) AS na, COUNT(*) FILTER (week >= {SPLIT_WEEK}) AS nb FROM long GROUP BY 1, 2, 3)",
    """cdf AS (SELECT *, SUM(na) OVER upto / SUM(na) OVER whole AS fa, SUM(nb) OVER upto / SUM(nb) OVER whole AS fb, LEAD(value) OVER upto - value AS step, SUM(na) OVER whole AS n_a, SUM(nb) OVER whole AS n_b
         FROM counts WINDOW upto AS (PARTITION BY stats_group, feature ORDER BY value), whole AS (PARTITION BY stats_group, feature))""",
    "tests AS (SELECT stats_group, feature, CAST(MAX(n_a) AS BIGINT) AS n_a, CAST(MAX(n_b) AS BIGINT) AS n_b, MAX(ABS(fa - fb)) AS ks, SUM(ABS(fa - fb) * step) AS wasserstein FROM cdf GROUP BY 1, 2)",
    "scaled AS (SELECT *, ks * (SQRT(n_a * n_b / (n_a + n_b)) + 0.12 + 0.11 / SQRT(n_a * n_b / (n_a + n_b))) AS x FROM tests)",
]


@query(
    "ks_two_sample",
    with_(SAMPLES, f"SELECT * EXCLUDE (x), CASE WHEN ks = 0 THEN 1 ELSE LEAST(1, GREATEST(0, 2 * list_sum(list_transform(range(1, {sa.TERMS + 1}), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * EXP(-2.0::DOUBLE * k * k * x * x))))) END AS p_value FROM scaled"),
    "ks wasserstein p_value",
)
def ks_two_sample(spark, sf):
    """Baseline against production values of each feature and group."""
    rows = cut(unpivot_features(stored_groups(spark, sf), [SEG, "week"], COLUMNS))
    return sa.two_sample(rows, [SEG, "feature"], "value", F.col("week") < SPLIT_WEEK)
