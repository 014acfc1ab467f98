"""Features with two times: the day they describe, and the batches in which they were known.

A row holds from the batch that brought it (``known_from``) until the batch that replaced it (``known_to``, null while it
holds). A batch closes the rows it changes and adds its own; it reads and rewrites the hash buckets of its entities only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastops.functions.keys import stable_bucket
from forecastops.operators.feature_store import latest_rows
from forecastops.operators.joins import null_safe_join
from forecastops.session import store
from forecastops.sources.tables import read_or_empty

#: Buckets of the stored history; a batch that touches every bucket rewrites the dataset.
BUCKETS = 64


def _schema(rows: DataFrame) -> T.StructType:
    known = [T.StructField("known_from", T.LongType()), T.StructField("known_to", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return T.StructType([*rows.schema.fields, *known])


def apply_batch(spark: SparkSession, path: str, rows: DataFrame, batch: int, entity: Sequence[str], day: str, *, buckets: int = BUCKETS) -> list[int]:
    """Bring the features ``rows`` (entity, day, values) of a batch into the history, and return the rewritten buckets.

    A row equal to the one that holds changes nothing; another closes it. Of rows that share entity and day the greatest
    counts. Repeating a batch gives the same history, and rows it now brings differently replace those it brought before.
    Batches come in order: an earlier one than the history holds for the same buckets is refused. Null entities and days are
    values like any other. The number of buckets must stay the same.
    """
    keys, schema = [*entity, day], _schema(rows)
    values = [c for c in rows.columns if c not in keys]
    whole = F.struct(*values)
    brought = rows.groupBy(*keys).agg(F.max(whole).alias("_new")).withColumn("bucket", stable_bucket(buckets, *entity))
    brought = store(brought)
    touched = sorted(r.bucket for r in brought.select("bucket").distinct().collect())
    if not touched:
        return []
    # the touched buckets are literals and prune the scan
    before = read_or_empty(spark, path, schema).where(F.col("bucket").isin(touched))
    last = before.agg(F.greatest(F.max("known_from"), F.max("known_to"))).first()[0]
    if last is not None and last > batch:
        raise ValueError(f"batch {batch} comes after batch {last}")
    held = before.where("known_to is null").select(*keys, "bucket", F.struct(*values, "known_from").alias("_old"))
    met = null_safe_join(held, brought, [*keys, "bucket"], "full")
    old = F.struct(*[F.col("_old")[c].alias(c) for c in values])
    same = old.eqNullSafe(F.col("_new"))
    row = lambda side, start, end: F.struct(*[F.col(side)[c].alias(c) for c in values], start.cast("bigint").alias("known_from"), end.cast("bigint").alias("known_to"))
    now, never = F.lit(batch), F.lit(None)
    kept = row("_old", F.col("_old.known_from"), never)
    closed = F.when(F.col("_old.known_from") < batch, row("_old", F.col("_old.known_from"), now))
    added = row("_new", now, never)
    out = F.when(F.col("_new").isNull() | (F.col("_old").isNotNull() & same), F.array(kept)).when(F.col("_old").isNull(), F.array(added)).otherwise(F.array(closed, added))
    changed = met.select(*keys, "bucket", F.explode(F.filter(out, lambda r: r.isNotNull())).alias("_r")).select(*keys, "_r.*", "bucket")
    after = store(changed.select(*schema.names).unionByName(before.where("known_to is not null")))
    after.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return touched


def known_in(history: DataFrame, batch: int) -> DataFrame:
    """The history as it stood after ``batch``."""
    return history.where((F.col("known_from") <= batch) & (F.col("known_to").isNull() | (F.col("known_to") > batch)))


def as_of(history: DataFrame, batch: int, at: Column, entity: Sequence[str], day: str) -> DataFrame:
    """Per entity the last features up to the day ``at`` that were known after ``batch``."""
    rows = known_in(history, batch).where(F.col(day) <= at).drop("known_from", "known_to", "bucket")
    return latest_rows(rows, entity, [day])


def changes(history: DataFrame, since: int, until: int) -> DataFrame:
    """Rows that came after batch ``since`` up to ``until``, and those that stopped holding then, told apart by ``change``."""
    came = history.where((F.col("known_from") > since) & (F.col("known_from") <= until))
    went = history.where((F.col("known_to") > since) & (F.col("known_to") <= until))
    return came.withColumn("change", F.lit("added")).unionByName(went.withColumn("change", F.lit("closed"))).drop("bucket")
