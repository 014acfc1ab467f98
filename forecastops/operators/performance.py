"""Pairing of forecasts with actuals, metric roll-ups and segment summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.functions import metrics as m
from forecastops.operators.joins import for_each_of

FULL_MODEL = "full_model"


def pair_actuals(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str], y: str, how: str = "inner") -> DataFrame:
    """Forecasts with their actuals: ``inner`` for a baseline, ``left`` (missing actual = 0) in production.

    Actuals carry no product key, so every product row of a (customer, brand, week) meets the same actual.
    """
    paired = predictions.join(actuals, list(keys), how)
    return paired.withColumn(y, F.coalesce(F.col(y), F.lit(0.0))) if how == "left" else paired


def metric_rollup(
    paired: DataFrame,
    dims: Sequence[str],
    y: str,
    yhat: str,
    base: Sequence[str] = ("week", "model_version"),
    *,
    metrics: Mapping[str, Column] | None = None,
    total_label: str = FULL_MODEL,
) -> DataFrame:
    """Long rows (base, aggregated_col, aggregated_value, metric_col, metric_value).

    Per dimension there is a row for each of its values and one for the whole model. Raw rows are reduced once to error
    sums per (base, all dimensions); the levels are sums of those.
    """
    sums = m.error_sums(y, yhat)
    cells = paired.groupBy(*base, *dims).agg(*[c.alias(n) for n, c in sums.items()])
    levels = F.array(
        *[
            F.struct(F.lit(d).alias("c"), v.alias("v"))
            for d in dims
            for v in (F.col(d).cast("string"), F.lit(total_label))
        ]
    )
    totals = (
        cells.withColumn("_level", F.explode(levels))
        .groupBy(*base, F.col("_level.c").alias("aggregated_col"), F.col("_level.v").alias("aggregated_value"))
        .agg(*[F.sum(n).alias(n) for n in sums])
    )
    chosen = dict(metrics or m.monitored())
    values = F.array(*[F.struct(F.lit(n).alias("k"), c.cast("double").alias("v")) for n, c in chosen.items()])
    return totals.select(*base, "aggregated_col", "aggregated_value", F.explode(values).alias("_m")).select(
        *base, "aggregated_col", "aggregated_value", F.col("_m.k").alias("metric_col"), F.col("_m.v").alias("metric_value")
    )


def metric_baseline(history: DataFrame, keys: Sequence[str] = ("model_version",)) -> DataFrame:
    """Mean of each metric over the baseline's weeks."""
    return history.groupBy(*keys, "aggregated_col", "aggregated_value", "metric_col").agg(
        F.avg("metric_value").alias("baseline_metric")
    )


def segment_summary(paired: DataFrame, seg: str, y: str, yhat: str) -> DataFrame:
    """Rows, mean forecast, mean actual, MAE, RMSE and MAPE per segment and over all (``overall``)."""
    sums = {**m.error_sums(y, yhat), "s_pred": F.sum(F.col(yhat).cast("double")), "s_actual": F.sum(F.col(y).cast("double"))}
    cells = paired.groupBy(F.col(seg).cast("string").alias("segment")).agg(
        F.count(F.lit(1)).alias("predictions"), *[c.alias(n) for n, c in sums.items()]
    )
    levels = F.explode(F.array("segment", F.lit("overall")))
    names = ["predictions", *sums]
    totals = cells.withColumn("segment", levels).groupBy("segment").agg(*[F.sum(n).alias(n) for n in names])
    return totals.select(
        "segment",
        "predictions",
        F.try_divide("s_pred", "s_n").alias("avg_predicted"),
        F.try_divide("s_actual", "s_n").alias("avg_actual"),
        m.mae().alias("mae"),
        m.rmse().alias("rmse"),
        m.mape("skip").alias("mape"),
    )


def mape_variants(paired: DataFrame, group: Sequence[str], y: str, yhat: str) -> DataFrame:
    """Percentage error under the three rules for zero actuals."""
    sums = m.error_sums(y, yhat)
    cells = paired.groupBy(*group).agg(*[c.alias(n) for n, c in sums.items()])
    return cells.select(*group, *[m.mape(z).alias(f"mape_{z}") for z in ("skip", "mask", "one")])


def forecast_vs_sales(
    forecasts: DataFrame, sales: DataFrame, keys: Sequence[str], *, model: str = "model_uri", y: str = "actual", yhat: str = "prediction"
) -> DataFrame:
    """Full outer pairing of forecasts and sales, zeros for the absent side.

    Sales that no model forecast count against every model: such rows are repeated once per model, and rows without a
    model do not remain beside them.
    """
    both = forecasts.join(sales, list(keys), "full").withColumns(
        {y: F.coalesce(F.col(y), F.lit(0.0)), yhat: F.coalesce(F.col(yhat), F.lit(0.0))}
    )
    orphans = both.where(F.col(model).isNull()).drop(model)
    repeated = for_each_of(orphans, forecasts.where(F.col(model).isNotNull()), model)
    return both.where(F.col(model).isNotNull()).unionByName(repeated)


def forecast_vs_sales_sums(
    forecasts: DataFrame, sales: DataFrame, keys: Sequence[str], cells: Sequence[str], *, model: str = "model_uri", y: str = "actual", yhat: str = "prediction"
) -> DataFrame:
    """(cells, model, row_count, actual, prediction, absolute_error, absolute_actual) of :func:`forecast_vs_sales`.

    Sales that no model forecast are summed per cell first, and only these sums are repeated once per model.
    """
    both = forecasts.join(sales, list(keys), "full").withColumns({y: F.coalesce(F.col(y), F.lit(0.0)), yhat: F.coalesce(F.col(yhat), F.lit(0.0))})
    sums = both.groupBy(*cells, model).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(y).alias(y), F.sum(yhat).alias(yhat),
        F.sum(F.abs(F.col(y) - F.col(yhat))).alias("absolute_error"), F.sum(F.abs(y)).alias("absolute_actual"),
    )
    repeated = for_each_of(sums.where(F.col(model).isNull()).drop(model), forecasts.where(F.col(model).isNotNull()), model)
    whole = sums.where(F.col(model).isNotNull()).unionByName(repeated).groupBy(*cells, model)
    return whole.agg(*[F.sum(c).alias(c) for c in ("row_count", y, yhat, "absolute_error", "absolute_actual")])


def compare_distributions(frames: Mapping[str, DataFrame], seg: str, columns: Sequence[str]) -> DataFrame:
    """Mean and standard deviation of several columns per source and segment, in one aggregation."""
    tagged = [df.select(F.lit(name).alias("source"), seg, *columns) for name, df in frames.items()]
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in columns:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return reduce(DataFrame.unionByName, tagged).groupBy("source", seg).agg(*aggs)


def compare_versions(
    candidate: DataFrame, production: DataFrame, actuals: DataFrame, keys: Sequence[str], y: str = "actual", yhat: str = "prediction"
) -> DataFrame:
    """Shadow table: both versions' forecasts of the same rows, joined on the row key, with their difference."""
    left = candidate.select(*keys, F.col(yhat).alias("candidate"))
    right = production.select(*keys, F.col(yhat).alias("production"))
    return (
        left.join(right, list(keys))
        .join(actuals.select(*keys, y), list(keys))
        .withColumn("difference", F.col("candidate") - F.col("production"))
    )


def version_metrics(shadow: DataFrame, y: str = "actual") -> DataFrame:
    """MAE, RMSE and MAPE of candidate and production on the same rows, side by side with the difference."""
    versions = ("candidate", "production")
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.col(v).alias("p")) for v in versions]))
    sums = shadow.select(y, each.alias("c")).select(y, "c.*").groupBy("version")
    wide = sums.agg(*[c.alias(n) for n, c in m.error_sums(y, "p").items()])
    chosen = {"mae": m.mae(), "rmse": m.rmse(), "mape": m.mape("one")}
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_col"), c.alias("v")) for n, c in chosen.items()]))
    value = lambda v: F.max(F.when(F.col("version") == v, F.col("v"))).alias(v)
    out = wide.select("version", values.alias("c")).select("version", "c.*").groupBy("metric_col").agg(*map(value, versions))
    return out.withColumn("difference", F.col("candidate") - F.col("production"))
