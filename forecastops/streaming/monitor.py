"""Windowed monitoring, the same code in batch and streaming, and incremental refresh of landing tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastops.functions import metrics as m
from forecastops.sources.landing import upsert_path


def windowed_sums(df: DataFrame, ts: str, seg: str, y: str, yhat: str, window: str = "1 day", delay: str | None = None) -> DataFrame:
    """Additive error sums per (time window, segment); with ``delay`` late rows are awaited that long (streaming)."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if delay:
        timed = timed.withWatermark(ts, delay)
    sums = m.error_sums(y, yhat)
    return (
        timed.groupBy(F.window(ts, window).alias("w"), F.col(seg))
        .agg(*[c.alias(n) for n, c in sums.items()])
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), seg, *sums)
    )


def window_metrics(sums: DataFrame, seg: str) -> DataFrame:
    """Metrics of the windows from their sums."""
    return sums.select(
        "window_start", seg, F.col("s_n").cast("bigint").alias("n_rows"), *[c.alias(n) for n, c in m.monitored().items()]
    )


def performance_between(sums: DataFrame, seg: str, metric: str, start: str, end: str) -> DataFrame:
    """One metric of a monitor over a time range."""
    kept = sums.where((F.col("window_start") >= F.lit(start).cast("timestamp")) & (F.col("window_start") < F.lit(end).cast("timestamp")))
    return kept.select("window_start", seg, m.monitored()[metric].alias("metric_value"))


def read_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A growing parquet dataset as a stream; ``name`` is a file name pattern within ``folder``."""
    known = schema or spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(known).option("pathGlobFilter", name).parquet(folder)


def land(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str], mode: str = "update") -> None:
    """Process what has arrived, upsert each micro-batch by key, and stop.

    A repeated micro-batch writes the same rows again, so the result does not depend on failures.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert_path(batch.sparkSession, path, batch, keys, partition_by)

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def refresh(
    spark: SparkSession,
    source: DataFrame,
    recompute: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
) -> None:
    """Bring a feature view up to date with the rows that arrived since the last run, and stop.

    ``recompute`` gets the arrived rows and returns the view's rows to replace; a view with a look-back window reads the
    history of the entities that occur in them.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert_path(spark, path, recompute(batch), keys, partition_by)

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
