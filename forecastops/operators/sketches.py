"""Stored, mergeable sketches: quantiles and distinct counts of any span of weeks without the rows.

A sketch is kept per (week, segment, feature) or (week, segment) in a dataset partitioned by week. A run adds the weeks that
are not there yet and reads no others; spans and higher levels are unions of sketches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.operators.histograms import unpivot_features
from forecastops.sources.tables import read_or_empty

#: Size of a quantile sketch (its rank error falls with it), and the base-2 logarithm of the distinct values that a distinct
#: sketch counts exactly.
QUANTILE_SIZE, DISTINCT_LOG = 400, 14
#: Rank error that quantiles of merged sketches stay within in all but about one case in a hundred.
RANK_ERROR = 0.01


def quantile_sketches(df: DataFrame, week: str, seg: str, features: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """(week, segment, feature, n, low, high, sketch) of numeric columns; nulls and NaN are left out."""
    long = unpivot_features(df, [week, seg], features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    value = F.col("value").cast("double")
    return long.groupBy(week, seg, "feature").agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")
    )


def distinct_sketches(df: DataFrame, week: str, seg: str, entity: str | Column, log: int = DISTINCT_LOG) -> DataFrame:
    """(week, segment, n_rows, sketch) of the distinct entities; null entities are left out."""
    who = F.col(entity) if isinstance(entity, str) else entity
    return df.groupBy(week, seg).agg(F.count(who).alias("n_rows"), F.theta_sketch_agg(who, F.lit(log)).alias("sketch"))


def add_weeks(spark: SparkSession, path: str, rows: DataFrame, week: str, make: Callable[[DataFrame], DataFrame]) -> list:
    """Add the sketches of the weeks that the dataset at ``path`` lacks, and return these weeks.

    The weeks there are known from the folders; as literals they keep their rows from being read again. Rows that arrive
    for a week already there do not change its sketch. A null week is a week like any other.
    """
    schema = make(rows).schema
    weeks = lambda: [r[0] for r in read_or_empty(spark, path, schema).select(week).distinct().collect()]
    landed = weeks()
    known = [w for w in landed if w is not None]
    there = F.when(F.col(week).isNull(), F.lit(None in landed)).otherwise(F.col(week).isin(known))
    make(rows.where(~there)).repartition(F.col(week)).write.mode("append").partitionBy(week).parquet(path)
    return sorted((w for w in weeks() if w not in landed), key=lambda w: (w is not None, w))


def sketched_quantiles(sketches: DataFrame, group: Sequence[str], probs: Sequence[float], size: int = QUANTILE_SIZE) -> DataFrame:
    """(group, n, low, high, qs): quantiles of the merged sketches, within ``RANK_ERROR`` of the rank asked for."""
    merged = sketches.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )
    asked = F.array(*[F.lit(float(p)) for p in probs])
    return merged.select(*group, "n", "low", "high", F.kll_sketch_get_quantile_double("sketch", asked).alias("qs"))


def sketched_edges(sketches: DataFrame, seg: str, bins: int = 20) -> DataFrame:
    """(seg, feature, n, edges): the distinct inner quantiles per segment and feature, as bins for histograms.

    A feature constant in a segment has no edges and no row.
    """
    qs = sketched_quantiles(sketches, [seg, "feature"], [i / bins for i in range(1, bins)])
    return qs.where("low < high").select(seg, "feature", "n", F.array_distinct("qs").alias("edges"))


def distinct_levels(sketches: DataFrame, levels: Sequence[Sequence[str]], log: int = DISTINCT_LOG) -> DataFrame:
    """(level columns, level, n_rows, n_distinct): entities at each level, from one read of the sketches.

    ``levels`` list the columns that a level keeps, the first naming all; those a level leaves out are null in its rows, and
    ``level`` counts them.
    """
    columns = list(levels[0])
    keep = F.array(*[F.struct(F.lit(len(columns) - len(kept)).alias("level"), *[(F.col(c) if c in kept else F.lit(None)).alias(c) for c in columns]) for kept in levels])
    spread = sketches.select(F.explode(keep).alias("k"), "n_rows", "sketch")
    merged = spread.groupBy("k").agg(F.sum("n_rows").alias("n_rows"), F.theta_union_agg("sketch", F.lit(log)).alias("sketch"))
    return merged.select("k.*", "n_rows", F.theta_sketch_estimate("sketch").alias("n_distinct"))
