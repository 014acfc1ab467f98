"""Dashboard and monitoring-table queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_rows(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """The ``n`` latest rows; each task keeps its own ``n`` before they meet."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def log_status(log: DataFrame, segment: str, entity: str, ts: str) -> DataFrame:
    """Rows, distinct segments and entities, first and last time of an inference log."""
    return log.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.countDistinct(segment).alias("segments"),
        F.countDistinct(entity).alias("entities"),
        F.min(ts).alias("first_log"),
        F.max(ts).alias("last_log"),
    )


def monitoring_tables(df: DataFrame, path: str, segment: str) -> None:
    """One monitoring dataset for all segments, a folder each, instead of a table per segment."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(segment).parquet(path)


def last_periods(df: DataFrame, period: str, n: int = 4) -> DataFrame:
    """The ``n`` latest distinct periods."""
    return df.select(period).distinct().orderBy(F.desc(period)).limit(n)
