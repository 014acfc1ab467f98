"""Control charts of windowed values: sigma levels and CUSUM, from additive sums, so batch and stream agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Deviations of the two alert levels; slack and decision limit of the CUSUM, in deviations.
SIGMAS, SLACK, DECISION = (2.0, 3.0), 0.5, 5.0
MIN_STD = 1e-6


def window_values(df: DataFrame, ts: str, keys: Sequence[str], value: str, window: str = "1 day", delay: str | None = None) -> DataFrame:
    """(window_start, keys, n, total) of each window; with ``delay`` late rows are awaited that long (streaming)."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if delay:
        timed = timed.withWatermark(ts, delay)
    sums = timed.groupBy(F.window(ts, window).alias("_w"), *keys).agg(F.count(value).alias("n"), F.sum(value).alias("total"))
    return sums.select(F.col("_w.start").alias("window_start"), *keys, "n", "total")


def control_chart(
    sums: DataFrame, keys: Sequence[str], in_control: Column, *, sigmas: tuple[float, float] = SIGMAS, slack: float = SLACK, decision: float = DECISION
) -> DataFrame:
    """(window_start, keys, value, z, cusum_high, cusum_low, sigma_level, shifted) of the windows in ``sums``.

    Mean and deviation come from the windows that ``in_control`` picks; without one of them the measures are null and the
    level is -1. A CUSUM is the running sum of deviations less the slack, never below 0: its running total minus the least
    total so far, so no row waits for another. A key's rows are as many as its windows, whatever the number of values.
    Windows without values are left out; a null key is a key.
    """
    rows = sums.where("n > 0").withColumn("value", F.col("total") / F.col("n"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    chosen = F.when(in_control, F.col("value"))
    rows = rows.withColumns({"_mean": F.avg(chosen).over(whole), "_sd": F.greatest(F.coalesce(F.stddev_samp(chosen).over(whole), F.lit(0.0)), F.lit(MIN_STD))})
    rows = rows.withColumn("z", (F.col("value") - F.col("_mean")) / F.col("_sd"))
    rows = rows.withColumns({"_high": F.sum(F.col("z") - slack).over(upto), "_low": F.sum(-F.col("z") - slack).over(upto)})
    cusum = lambda c: F.col(c) - F.least(F.lit(0.0), F.min(c).over(upto))
    rows = rows.withColumns({"cusum_high": F.when(F.col("z").isNotNull(), cusum("_high")), "cusum_low": F.when(F.col("z").isNotNull(), cusum("_low"))})
    away = F.abs("z")
    level = F.when(away.isNull(), -1).when(away >= sigmas[1], 2).when(away >= sigmas[0], 1).otherwise(0)
    shifted = (F.col("cusum_high") > decision) | (F.col("cusum_low") > decision)
    return rows.select("window_start", *keys, "value", "z", "cusum_high", "cusum_low", level.alias("sigma_level"), shifted.alias("shifted"))
