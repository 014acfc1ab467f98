"""Data-quality reports: nulls, distributions, outliers, group checks, dataset comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.operators.ranking import quantiles


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and null count per column, one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def target_distribution(df: DataFrame, y: str, exact: bool = True) -> DataFrame:
    """Long form (statistic, value) of a column: ``n``, ``mean``, ``sd`` and the quantiles ``p0`` to ``p100`` by 25."""
    levels = (0, 25, 50, 75, 100)
    q = quantiles(df, [], y, [p / 100 for p in levels], exact=exact).select("qs").scalar()
    one = df.where(F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd")
    )
    wide = one.withColumn("_q", q).select("n", "mean", "sd", *[F.get("_q", F.lit(i)).alias(f"p{p}") for i, p in enumerate(levels)])
    return wide.unpivot([], wide.columns, "statistic", "value")


def outliers_3sigma(df: DataFrame, y: str, sigmas: float = 3.0) -> DataFrame:
    """(side, n, share, nearest, farthest) of the values more than ``sigmas`` standard deviations below or above the mean.

    Distances are in standard deviations, the share is of all values; a side without such values has no row.
    """
    v = F.col(y).cast("double")
    present = df.where(v.isNotNull()).select(v.alias("_v"))
    spread = present.agg(F.struct(F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("sd"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    away = present.select(spread.alias("_s"), F.try_divide(F.col("_v") - F.col("_s.mean"), F.col("_s.sd")).alias("_away")).where(F.abs("_away") > sigmas)
    side = F.when(F.col("_away") < 0, "below").otherwise("above").alias("side")
    return away.groupBy(side).agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / F.first("_s.n")).alias("share"), F.min(F.abs("_away")).alias("nearest"), F.max(F.abs("_away")).alias("farthest")
    )


def group_distribution(df: DataFrame, group: str, entity: str, y: str) -> DataFrame:
    """(group, share, rows_per_entity, mean, sd): how rows and target spread over the groups; a null group is a group."""
    known = F.col(entity).isNotNull()
    parts = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(known).alias("_named"), F.countDistinct(entity).alias("_entities"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("sd")
    )
    # one row per group
    every = parts.agg(F.sum("_rows")).scalar()
    return parts.select(group, (F.col("_rows") / every).alias("share"), F.try_divide(F.col("_named"), F.col("_entities")).alias("rows_per_entity"), "mean", "sd")


def group_check(df: DataFrame, group: str, expected: int = 16, least: int = 100) -> DataFrame:
    """One row: number of groups against the expected number, smallest and largest group, and both verdicts."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("group_count"), F.min("n").alias("min_records"), F.max("n").alias("max_records")
    ).withColumns(
        {
            "groups_as_expected": F.col("group_count") == expected,
            "all_groups_sufficient": F.coalesce(F.col("min_records") >= least, F.lit(False)),
        }
    )


def dataset_comparison(datasets: Mapping[str, DataFrame], entity: str, week: str) -> DataFrame:
    """Rows, distinct entities and distinct weeks of several datasets."""
    tagged = [df.select(F.lit(name).alias("dataset"), entity, week) for name, df in datasets.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.countDistinct(entity).alias("unique_entities"),
            F.countDistinct(week).alias("unique_weeks"),
        )
    )


def date_ranges(df: DataFrame, part: str | Column, date: str) -> DataFrame:
    """Calendar coverage per ``part``: rows, first and last day, days that occur, and days between that do not."""
    key = F.col(part) if isinstance(part, str) else part
    per_day = df.groupBy(key.alias("part"), F.col(date).cast("date").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    days = per_day.groupBy("part").agg(
        F.sum("_n").alias("n_rows"), F.min("_d").alias("first_day"), F.max("_d").alias("last_day"), F.count("_d").alias("days_present")
    )
    return days.withColumn("days_absent", F.datediff("last_day", "first_day") + 1 - F.col("days_present"))


def sufficiency(df: DataFrame, segment: str, entity: str, week: str) -> DataFrame:
    """Whether each segment has the rows and entities to be trained on."""
    # Fixed values: (rows, entities) needed for each verdict.
    enough, marginal = (100, 10), (50, 5)
    reach = lambda need: (F.col("records") >= need[0]) & (F.col("entities") >= need[1])
    return (
        df.groupBy(segment)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.countDistinct(entity).alias("entities"),
            F.countDistinct(week).alias("weeks"),
        )
        .withColumn(
            "data_quality",
            F.when(reach(enough), "SUFFICIENT").when(reach(marginal), "MARGINAL").otherwise("INSUFFICIENT"),
        )
    )


def schema_compat(train: DataFrame, inference: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per feature column of either dataset: where it occurs and how many values it holds there.

    A column that exists but holds no value at scoring time is as bad as a missing one, so the counts are part of it.
    """
    out_of = {c.lower() for c in exclude}
    left = [c for c in train.columns if c.lower() not in out_of]
    right = [c for c in inference.columns if c.lower() not in out_of]
    names = sorted(set(left) | set(right))

    def counts(df: DataFrame, present: Sequence[str], label: str) -> DataFrame:
        one = df.agg(*[(F.count(c) if c in present else F.lit(None).cast("bigint")).alias(c) for c in names])
        return one.unpivot([], names, "column_name", label)

    status = (
        F.when(F.col("inference_values").isNull(), "missing_in_inference")
        .when(F.col("train_values").isNull(), "missing_in_train")
        .otherwise("match")
    )
    return (
        counts(train, left, "train_values")
        .join(counts(inference, right, "inference_values"), "column_name")
        .withColumn("status", status)
    )


def category_rollup(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Per category its catalogue and its sales: products listed and sold, middle of their list prices, units, revenue per unit.

    Transactions are summed per product before the join; a category without sales has 0 units.
    """
    per_product = tx.groupBy("product_id").agg(F.sum("units").alias("u"), F.sum("revenue").alias("r"))
    units = F.coalesce(F.sum("u"), F.lit(0.0))
    return (
        products.join(per_product, "product_id", "left")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("listed"),
            F.count("u").alias("sold"),
            ((F.min("price") + F.max("price")) / 2).alias("middle_price"),
            units.alias("units"),
            F.try_divide(F.sum("r"), F.sum("u")).alias("revenue_per_unit"),
        )
    )


def yearly_summary(weekly: DataFrame) -> DataFrame:
    """Per year the number of customer weeks, units per customer week, and the week with most units (the earlier on a tie).

    Weeks are summed first; the year is read from those sums.
    """
    per_week = weekly.groupBy("week_start_date").agg(F.count(F.lit(1)).alias("n"), F.sum("weekly_sales_units").alias("u"))
    return per_week.groupBy(F.year("week_start_date").alias("year")).agg(
        F.sum("n").alias("customer_weeks"),
        (F.sum("u") / F.sum("n")).alias("units_per_customer_week"),
        F.max_by("week_start_date", F.struct("u", -F.unix_date("week_start_date"))).alias("top_week"),
    )
