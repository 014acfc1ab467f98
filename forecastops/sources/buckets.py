"""Bucketed tables: rows hashed and sorted by their keys once, joined without a shuffle ever after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.session import shared_folder


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> str:
    """Write ``df`` as table ``name``, bucketed and sorted by ``keys``, one file a bucket; returns the name.

    ``keys`` should be fine-grained (entity and period): rows that share all of them lie in one file. An existing table of
    the name is replaced. The files go to ``path``, or to the shared folder.
    """
    spark = df.sparkSession
    location = path or f"{shared_folder(spark)}/buckets/{name}"
    ready = df.repartition(buckets, *keys)
    ready.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option("path", location).saveAsTable(name)
    return name


def bucket_join(spark: SparkSession, left: str, right: str, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables that are bucketed alike by ``keys``: buckets meet their like, and nothing is shuffled.

    Raises if the bucketing of the two differs, as Spark would then shuffle one side without a word.
    """
    first, second = bucketing(spark, left), bucketing(spark, right)
    if first != second or first[1] != [k.lower() for k in keys]:
        raise ValueError(f"{left} is bucketed by {first}, {right} by {second}, joined on {list(keys)}")
    return spark.table(left).hint("merge").join(spark.table(right), list(keys), how)


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """(buckets, columns) of a table; (0, []) for one without buckets."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").where(F.col("col_name").isin("Num Buckets", "Bucket Columns")).collect()}
    columns = [c.strip(" `[]").lower() for c in rows.get("Bucket Columns", "").split(",")]
    return int(rows.get("Num Buckets", 0)), [c for c in columns if c]
