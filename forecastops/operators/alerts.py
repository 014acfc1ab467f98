"""Alert levels from thresholds, relative change, control limits, and the rollback decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.functions.metrics import DIRECTION, EPS

CELL = ("aggregated_col", "aggregated_value", "metric_col")

# Relative limits (warning, critical) for error metrics and for F1, control limits in standard
# deviations, the smallest standard deviation, error bands, reasons and limits of the rollback decision.
ERROR_LIMITS = (0.20, 0.50)
F1_LIMITS = (-0.15, -0.30)
SIGMAS = (2.0, 3.0)
MIN_STD = 1e-9
NO_BASELINE = -1
STATUS = ("HIGH ERROR", "MODERATE ERROR", "LOW ERROR")
ALL_WELL, TOO_FEW = "All metrics within thresholds", "Insufficient samples ("
PSI_TEXT, KL_TEXT, RMSE_TEXT = "data_drift_psi=%.2f > ", "prediction_drift_kl=%.3f > ", "rmse_increase="
ROLLBACK = {"psi": 0.2, "kl": 0.1, "rmse_increase": 0.25, "min_samples": 1000}


def relative_alert(metrics: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("model_version",)) -> DataFrame:
    """Relative change of each metric from its baseline mean, with limits and alert level.

    A metric without baseline has a null change and level 0.
    """
    joined = metrics.join(baseline, [*keys, *CELL], "left")
    change = (F.col("metric_value") - F.col("baseline_metric")) / F.greatest(F.abs("baseline_metric"), F.lit(EPS))
    drift = F.when(F.col("baseline_metric").isNotNull(), change)
    is_f1 = F.col("metric_col") == "f1_binary"
    limit = lambda i: F.when(is_f1, F1_LIMITS[i]).otherwise(ERROR_LIMITS[i])
    beyond = lambda i: F.when(is_f1, F.col("metric_drift") < F1_LIMITS[i]).otherwise(F.col("metric_drift") > ERROR_LIMITS[i])
    return joined.withColumn("metric_drift", drift).withColumns(
        {
            "warning_threshold": limit(0),
            "critical_threshold": limit(1),
            "alert_level": F.when(beyond(1), 2).when(beyond(0), 1).otherwise(0),
        }
    )


def _sign() -> Column:
    """+1 where a higher metric is worse, -1 where a lower one is; unknown metrics count as errors."""
    lower_is_worse = [m for m, d in DIRECTION.items() if d < 0]
    return F.when(F.col("metric_col").isin(*lower_is_worse), -1.0).otherwise(1.0)


def control_stats(history: DataFrame, in_control: DataFrame, keys: Sequence[str], week: str = "week") -> DataFrame:
    """Weeks, mean and standard deviation of each metric over its model's in-control weeks."""
    kept = history.join(in_control.select(*keys, week).distinct(), [*keys, week], "left_semi")
    return kept.groupBy(*keys, *CELL).agg(
        # a set of weeks is as small as the calendar, and needs no second shuffle
        F.size(F.collect_set(week)).cast("bigint").alias("n_baseline_weeks"),
        F.avg("metric_value").alias("mean_baseline"),
        F.stddev_samp("metric_value").alias("stddev_baseline"),
    )


def sigma_alert(
    current: DataFrame,
    history: DataFrame,
    in_control: DataFrame,
    keys: Sequence[str] = ("model_version",),
    *,
    week: str = "week",
    sigmas: tuple[float, float] = SIGMAS,
    min_weeks: int = 1,
) -> DataFrame:
    """Control-chart alert: levels 1 and 2 at ``sigmas`` deviations on the bad side, -1 without a baseline.

    ``in_control`` lists the (keys, week) pairs that make a model's baseline.
    """
    stats = control_stats(history, in_control, keys, week)
    sd = F.greatest(F.coalesce("stddev_baseline", F.lit(0.0)), F.lit(MIN_STD))
    away = _sign() * (F.col("metric_value") - F.col("mean_baseline"))
    valid = (F.coalesce("n_baseline_weeks", F.lit(0)) >= min_weeks) & F.col("mean_baseline").isNotNull()
    return current.join(stats, [*keys, *CELL], "left").withColumns(
        {
            "warning_threshold": F.col("mean_baseline") + _sign() * sigmas[0] * sd,
            "critical_threshold": F.col("mean_baseline") + _sign() * sigmas[1] * sd,
            "alert_level": F.when(~valid, NO_BASELINE)
            .when(away >= sigmas[1] * sd, 2)
            .when(away >= sigmas[0] * sd, 1)
            .otherwise(0),
        }
    )


def performance_status(rmse: str = "rmse", limits: tuple[float, float] = (0.5, 1.0)) -> Column:
    """Error band of a segment by its RMSE."""
    return (
        F.when(F.col(rmse) > limits[1], STATUS[0]).when(F.col(rmse) > limits[0], STATUS[1]).otherwise(STATUS[2])
    )


def rollback_decision(metrics: DataFrame, config: Mapping[str, float] | None = None) -> DataFrame:
    """``action`` and ``reason`` per model from ``sample_count``, ``psi``, ``kl`` and ``rmse_increase``.

    Too few samples: skip. Any limit exceeded: rollback, with the exceeded limits joined as reason. Otherwise none.
    """
    c = {**ROLLBACK, **(config or {})}
    percent = lambda v: F.concat(F.round(v * 100).cast("int").cast("string"), F.lit("%"))
    triggers = F.array_compact(
        F.array(
            F.when(F.col("psi") > c["psi"], F.format_string(f"{PSI_TEXT}{c['psi']}", "psi")),
            F.when(F.col("kl") > c["kl"], F.format_string(f"{KL_TEXT}{c['kl']}", "kl")),
            F.when(
                F.col("rmse_increase") > c["rmse_increase"],
                F.concat(F.lit(RMSE_TEXT), percent(F.col("rmse_increase")), F.lit(" > "), percent(F.lit(c["rmse_increase"]))),
            ),
        )
    )
    few = F.coalesce("sample_count", F.lit(0)) < c["min_samples"]
    any_trigger = F.size(triggers) > 0
    few_text = F.concat(F.lit(TOO_FEW), F.coalesce("sample_count", F.lit(0)).cast("string"), F.lit(")"))
    return metrics.withColumns(
        {
            "action": F.when(few, "skip").when(any_trigger, "rollback").otherwise("none"),
            "reason": F.when(few, few_text)
            .when(any_trigger, F.concat_ws("; ", triggers))
            .otherwise(ALL_WELL),
        }
    )
