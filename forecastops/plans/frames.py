"""Input frames of the registered queries, built from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.operators.features import training_features
from forecastops.operators.segments import pattern_group, stats_group_by_activity
from forecastops.plans.registry import SHORT_FAMILY, SPLIT_WEEK
from forecastops.session import store
from forecastops.sources.tables import transactions, weekly_sales

SERIES_IDS = ["customer_id", "brand"]
ROW_IDS = ["customer_id", "brand", "week"]


def last_day(spark: SparkSession, folder: str) -> Column:
    """The newest order date, standing for "today".

    A monitoring job is given its date; as a literal it reaches the scans as a pushed filter.
    """
    newest = spark.read.parquet(f"{folder}/orders.parquet").agg(F.max("o_orderdate").cast("date")).first()[0]
    return F.lit(newest)


def features(spark: SparkSession, folder: str) -> DataFrame:
    return training_features(weekly_sales(spark, folder), SERIES_IDS, "week", "y", SHORT_FAMILY)


def grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows with sales in the last four weeks, their group, a naive forecast and two more breakdown columns."""
    rows = stats_group_by_activity(pattern_group(features(spark, folder)))
    return rows.withColumns(
        {
            "prediction": F.col("w_m1_total"),
            "quarter": F.least(F.ceil(F.col("week_of_year") / 13.0), F.lit(4)).cast("int"),
            "cust_category": F.when(F.col("brand").isin("PROMO", "ECONOMY"), "VALUE").otherwise("REGULAR"),
        }
    )


def stored_groups(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`grouped` as a written table, for queries that read it more than once."""
    return store(grouped(spark, folder))


def baseline(df: DataFrame) -> DataFrame:
    return df.where(F.col("week") < SPLIT_WEEK)


def production(df: DataFrame) -> DataFrame:
    return df.where(F.col("week") >= SPLIT_WEEK)


__all__ = ["ROW_IDS", "SERIES_IDS", "baseline", "features", "grouped", "last_day", "production", "stored_groups", "transactions", "weekly_sales"]
