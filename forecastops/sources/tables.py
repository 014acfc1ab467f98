"""Scans: single tables, partition slices, directory sets; and the mapping of the test tables to retail inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastops.functions.calendar import iso_week


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_slice(spark: SparkSession, path: str, column: str, values: Sequence) -> DataFrame:
    """Rows of the given partition values; on a dataset partitioned by ``column`` only those folders are listed."""
    return spark.read.parquet(path).where(F.col(column).isin(list(values)))


def read_many(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union by name of several dataset folders, columns missing in some of them null."""
    frames = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Dataset under ``path``, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def register_view(df: DataFrame, name: str) -> str:
    """Name of a session view on ``df`` for use in SQL; an earlier view of that name is replaced."""
    df.createOrReplaceTempView(name)
    return name


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


# --- the driver's star schema read as retail data -------------------------------------------------------------------


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sold line: customer, product, order, date, ISO week, units, revenue."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    # calendar attributes are worked out per order, not per line
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("tx_date"), iso_week("o_orderdate").alias("week")
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderkey").alias("transaction_id"),
        "tx_date",
        "week",
        F.col("l_quantity").alias("units"),
        F.col("l_extendedprice").alias("revenue"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_mktsegment").alias("market"),
    )


def weekly_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly panel: outlet (nation) x brand presentation (part type) x ISO week, units sold as target ``y``."""
    sold = transactions(spark, folder).select("customer_id", "product_id", "week", "units")
    outlets = customers(spark, folder).select("customer_id", "nation_id")
    kinds = products(spark, folder).select("product_id", "category")
    return (
        sold.join(outlets, "customer_id")
        .join(kinds, "product_id")
        .groupBy(F.col("nation_id").alias("customer_id"), F.col("category").alias("brand"), "week")
        .agg(F.sum("units").alias("y"))
    )
