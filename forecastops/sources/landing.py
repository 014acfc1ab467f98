"""Landing datasets: idempotent upserts, missing slices, environment sync, snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.functions.calendar import calmonth, week_to_date
from forecastops.session import cut
from forecastops.sources.tables import read_or_empty


#: Partitions that one upsert touches at most; their values become literals of the filter that prunes the read.
TOUCHED_PARTITIONS = 10_000


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``other`` does not have; nulls are values like any other."""
    named = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    condition = [df[k].eqNullSafe(named[f"_k_{k}"]) for k in keys]
    return df.join(named, condition, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is absent from ``source``, plus all of ``source``.

    Columns new in either frame are kept and null on the other side. Null key parts match null key parts.
    """
    return without_keys(target, source, keys).unionByName(source, allowMissingColumns=True)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    twice = df.groupBy(*keys).count().where("count > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"more than one row for a key over {list(keys)}")
    return df


def among(values: DataFrame, most: int = TOUCHED_PARTITIONS) -> Column:
    """Condition that the columns of ``values`` take one of its distinct rows, as literals that prune partitions of a scan.

    The rows come to the driver, ``most`` of them at most; more raise.
    """
    rows = values.distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} distinct values of {values.columns}")
    if len(values.columns) == 1:
        name = values.columns[0]
        known = [r[0] for r in rows if r[0] is not None]
        has = F.col(name).isin(known) if known else F.lit(False)
        return has | F.col(name).isNull() if len(known) < len(rows) else has
    each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in values.columns]) for r in rows]
    return reduce(or_, each) if each else F.lit(False)


def upsert_path(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Upsert into a partitioned dataset, reading and rewriting only the partitions the source touches.

    The partition columns must belong to the key, so that a record cannot move between partitions. The write replaces
    whole partitions when the job commits; running it again gives the same dataset. Touched partitions are few, so their
    values prune the scan as literals; rows in a null partition or with null key parts are matched like any other.
    """
    outside = set(partition_by) - set(keys)
    if outside:
        raise ValueError(f"partition columns outside the key: {sorted(outside)}")
    source = require_unique(cut(source), keys)
    current = read_or_empty(spark, path, source.schema).where(among(source.select(*partition_by)))
    (
        upsert(current, source, keys)
        .select(source.columns)
        # few files per partition, a large partition spread over several tasks (AQE)
        .hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def missing_slices(source: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key combinations of ``source`` that ``landed`` does not have."""
    return without_keys(source.select(*keys).distinct(), landed.select(*keys).distinct(), keys)


def new_combos(
    predictions: DataFrame,
    landed: DataFrame,
    agg_col: str,
    metric: str,
    min_week: int | None = None,
) -> DataFrame:
    """(week, model_version) pairs that have predictions but no landed metric of this kind yet.

    Compare with the *metric* table, not the histogram table, so that a run that broke off between the two is repeated.
    """
    wanted = predictions
    if min_week is not None:
        if "calmonth" in predictions.columns:
            # the month follows from the week, and datasets are partitioned by it
            wanted = wanted.where(F.col("calmonth") >= calmonth(week_to_date(F.lit(min_week))))
        wanted = wanted.where(F.col("week") >= min_week)
    wanted = wanted.select("week", "model_version")
    done = landed.where((F.col("aggregated_col") == agg_col) & (F.col("metric_col") == metric)).select("week", "model_version")
    return missing_slices(wanted, done, ["week", "model_version"])


def unsynced_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` in slices (key combinations) that ``target`` lacks entirely: one append brings it up to date."""
    return without_keys(source, target.select(*keys).distinct(), keys)


def sync_path(
    spark: SparkSession, source_path: str, target_path: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Append to the target environment the slices it does not have."""
    source = spark.read.parquet(source_path)
    target = read_or_empty(spark, target_path, source.schema)
    writer = cut(unsynced_rows(source, target, keys)).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target_path)


def create_like(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Empty dataset with the schema of ``df``, unless the path already holds one."""
    spark.createDataFrame([], df.schema).write.mode("ignore").parquet(path)


def snapshot(spark: SparkSession, source_path: str, target_path: str, partition_by: Sequence[str] = ()) -> None:
    """Independent copy of a dataset as it is now, in the layout of ``partition_by``.

    The target must not exist: a copy that breaks off then never replaces a whole one.
    """
    writer = spark.read.parquet(source_path).write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target_path)


def write_by_segment(
    spark: SparkSession, df: DataFrame, path: str, segment: str, fraction: float = 1.0, seed: int = 42
) -> None:
    """One folder per segment in a single pass, leaving out segments already written; a null segment is one of them."""
    done = read_or_empty(spark, path, df.schema).select(segment).distinct()
    todo = without_keys(df, cut(done), [segment])
    if fraction < 1.0:
        todo = todo.sample(fraction, seed)
    todo.write.mode("append").partitionBy(segment).parquet(path)


def landing_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per landing table."""
    counts = [df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
