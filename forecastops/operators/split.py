"""Cleaning and splits: outlier cut, temporal holdout per segment, row-wise temporal split, keyed random split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.functions.keys import stable_bucket
from forecastops.operators.joins import null_safe_join
from forecastops.operators.ranking import number_rows, quantiles
from forecastops.session import lookup


def clean(
    df: DataFrame, required: Sequence[str], y: str, p: float = 0.99, *, mode: str = "drop", exact: bool = True
) -> DataFrame:
    """Rows with all required columns and a target between 0 and its global ``p`` quantile.

    ``mode="clip"`` keeps rows above the quantile and lowers their target to it. The quantile is computed once and read
    as a scalar.
    """
    top = quantiles(df, [], y, [p], exact=exact).select(F.get("qs", F.lit(0)).alias("top")).scalar()
    keep = F.col(y).isNotNull() & (F.col(y) >= 0)
    for c in required:
        keep = keep & F.col(c).isNotNull()
    if mode == "clip":
        return df.where(keep).withColumn(y, F.least(F.col(y), top))
    return df.where(keep & (F.col(y) <= top))


def clean_inference(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(required))


def holdout_thresholds(df: DataFrame, seg: str, week: str, frac: float = 0.1) -> DataFrame:
    """Per segment the first week at which the cumulative share of rows reaches ``1 - frac``.

    The window runs over (segment, week) counts, so its groups are as long as the calendar whatever the row count.
    """
    counts = df.groupBy(seg, week).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(seg)
    running = F.sum("_n").over(w.orderBy(week).rowsBetween(Window.unboundedPreceding, 0))
    share = counts.withColumn("_share", running / F.sum("_n").over(w))
    return share.where(F.col("_share") >= 1.0 - frac).groupBy(seg).agg(F.min(week).alias("cutoff_week"))


def clean_and_holdout(
    df: DataFrame, seg: str, week: str, ids: Sequence[str], y: str, frac: float = 0.1, p: float = 0.99, *, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) of the cleaned rows: up to each segment's cut-off week, and after it; a null segment is one too.

    The rows are read once for the quantile, once for the weekly counts and once per result: pass a stored frame.
    """
    cleaned = clean(df, [*ids, week], y, p, exact=exact)
    cuts = lookup(holdout_thresholds(cleaned, seg, week, frac))
    joined = null_safe_join(cleaned, cuts, [seg])
    return (
        joined.where(F.col(week) <= F.col("cutoff_week")).drop("cutoff_week"),
        joined.where(F.col(week) > F.col("cutoff_week")).drop("cutoff_week"),
    )


def temporal_split(
    df: DataFrame, seg: str, week: str, ids: Sequence[str], test: float = 0.2, *, by: str = "row"
) -> DataFrame:
    """Add ``is_test``: per segment the oldest floor(n * (1 - test)) rows are training rows.

    Only one week per segment can straddle the cut; every other row is decided by its week alone, and just the rows of
    the straddling weeks are ordered (by ``ids``). ``by="week"`` keeps the straddling week whole, in training. Rows without
    week are the oldest. The rows are read three times: pass a stored frame.
    """
    counts = df.groupBy(seg, week).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(seg)
    upto = F.sum("_n").over(w.orderBy(week).rowsBetween(Window.unboundedPreceding, 0))
    cut_at = F.floor(F.sum("_n").over(w) * (1.0 - test)).cast("bigint")
    edges = (
        counts.withColumns({"_upto": upto, "_cut": cut_at})
        .where("_upto >= _cut")
        .groupBy(seg)
        .agg(F.min(F.struct(F.col(week).isNotNull().alias("has"), F.col(week).alias("w"), (F.col("_cut") - F.col("_upto") + F.col("_n")).alias("take"))).alias("_e"))
        .select(F.col(seg).alias("_seg"), F.col("_e.w").alias("_w"), F.col("_e.take").alias("_take"))
    )
    joined = df.join(lookup(edges), df[seg].eqNullSafe(F.col("_seg"))).drop("_seg")
    later = F.col(week).isNotNull() & (F.col("_w").isNull() | (F.col(week) > F.col("_w")))
    if by == "week":
        return joined.withColumn("is_test", later).drop("_w", "_take")
    decided = joined.where(~F.col(week).eqNullSafe(F.col("_w"))).withColumn("is_test", later)
    straddling = number_rows(joined.where(F.col(week).eqNullSafe(F.col("_w"))), [seg], ids, position="_rn")
    straddling = straddling.withColumn("is_test", F.col("_rn") > F.col("_take")).drop("_rn")
    return decided.unionByName(straddling).drop("_w", "_take")


def random_split(df: DataFrame, ids: Sequence[str], test_percent: int = 20) -> DataFrame:
    """Add ``is_test`` from a hash of the key: repeatable, and independent of partitioning and file order."""
    return df.withColumn("is_test", stable_bucket(100, *ids) < test_percent)


def keyed_sample(df: DataFrame, ids: Sequence[str], percent: int) -> DataFrame:
    """The rows whose key hashes into the first ``percent`` of 100 buckets."""
    return df.where(stable_bucket(100, *ids) < percent)


def fill_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null feature values as 0."""
    return df.na.fill(0, list(columns))


def since(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.where(F.col(column) >= value)
