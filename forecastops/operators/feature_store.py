"""Batch-incremental feature store: pending rows, history, latest rows, run log, reads as of a batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastops.session import cut
from forecastops.sources.landing import upsert, upsert_path, without_keys
from forecastops.sources.tables import read_or_empty

PROCESSED = "PROCESSED"
RUN_LOG = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("feature_rows", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("folder", T.StringType()),
    ]
)
ROW_LOG = T.StructType(
    [T.StructField("row_digest", T.StringType()), T.StructField("batch_id", T.StringType()), T.StructField("run", T.IntegerType())]
)


def latest_rows(features: DataFrame, entity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per entity by ``order``, as an aggregate with map-side combine rather than a sort of each entity."""
    rest = [c for c in features.columns if c not in entity]
    return features.groupBy(*entity).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*entity, "_r.*")


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows per group in a total order.

    Spark keeps at most ``k`` rows per group and task before the shuffle (window group limit).
    """
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= k).drop("_rn")


def merge_latest(latest: DataFrame, batch: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Latest table after a batch: the batch's entities replaced, the others kept."""
    return upsert(latest, batch, entity)


def features_of_batch(history: DataFrame, batch_id: str) -> DataFrame:
    """Features as a given batch left them (for training)."""
    return history.where(F.col("batch_id") == batch_id)


def features_as_of(history: DataFrame, entity: Sequence[str], feature_ts: str, at: Column) -> DataFrame:
    """Last features per entity known at a time (for inference as of then)."""
    return latest_rows(history.where(F.col(feature_ts) <= at), entity, [feature_ts])


def run_batch(
    spark: SparkSession,
    source: DataFrame,
    batch_id: str,
    compute: Callable[[DataFrame], DataFrame],
    root: str,
    entity: Sequence[str],
    *,
    latest_mode: str = "merge",
) -> DataFrame:
    """Compute the features of a batch's pending rows, write history and latest table, log the run.

    A row is pending until a logged run of the batch has seen it, so rows that arrive after their batch was processed are
    taken up by the next call; the features of their entities are computed from all rows offered for these. History is
    partitioned by batch and upserted by entity, and the log row comes last, so a run that broke off can be repeated.
    ``latest_mode="recreate"`` keeps only the rows just computed in the latest table. The latest table is written as a new
    folder per run; readers take the folder of the last logged run (:func:`read_latest`).
    """
    log = read_or_empty(spark, f"{root}/runs", RUN_LOG)
    rows = source.withColumn("row_digest", F.sha2(F.to_json(F.struct(*source.columns), {"ignoreNullFields": "false"}), 256))
    done = log.where((F.col("status") == PROCESSED) & (F.col("batch_id") == batch_id))
    runs = done.count()
    # digests count once their run is logged
    seen = read_or_empty(spark, f"{root}/rows", ROW_LOG).where((F.col("batch_id") == batch_id) & (F.col("run") < runs))
    pending = cut(without_keys(rows, seen.select("row_digest").distinct(), ["row_digest"]))
    if pending.isEmpty():
        return log
    known = all(e in source.columns for e in entity)
    offered = rows.join(pending.select(*entity).distinct(), list(entity), "left_semi") if runs and known else rows if runs else pending
    features = cut(compute(offered.drop("row_digest")).withColumn("batch_id", F.lit(batch_id)))
    upsert_path(spark, f"{root}/history", features, [*entity, "batch_id"], ["batch_id"])
    run_rows = pending.select("row_digest", F.lit(batch_id).alias("batch_id"), F.lit(runs).alias("run"))
    run_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "run").parquet(f"{root}/rows")
    before = read_latest(spark, root, features.schema) if latest_mode == "merge" else None
    now = features if before is None else merge_latest(before, features, entity)
    now.write.mode("overwrite").parquet(f"{root}/latest/{batch_id}-{runs}")
    row = pending.agg(
        F.lit(batch_id).alias("batch_id"),
        F.lit(PROCESSED).alias("status"),
        F.count(F.lit(1)).alias("source_rows"),
        F.lit(features.count()).cast("bigint").alias("feature_rows"),
        F.current_timestamp().alias("finished_at"),
        F.lit(f"{batch_id}-{runs}").alias("folder"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return read_or_empty(spark, f"{root}/runs", RUN_LOG)


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Latest feature row per entity after the last processed batch; None (or no rows) before the first."""
    log = read_or_empty(spark, f"{root}/runs", RUN_LOG)
    last = log.where(F.col("status") == PROCESSED).orderBy(F.desc("finished_at"), F.desc("folder")).select("folder").first()
    if last is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    return spark.read.parquet(f"{root}/latest/{last['folder']}")
