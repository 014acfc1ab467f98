"""Forecast-error formulas.

Every metric is a closed formula of sums, so raw rows are reduced once to :func:`error_sums` and any coarser level is
reached by adding sums up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-10
MAPE_MASK = 1e-8

#: metric name -> +1 where higher is worse, -1 where lower is worse
DIRECTION = {"wape": 1, "rmse": 1, "mae": 1, "mape": 1, "f1_binary": -1}


def error_sums(actual: str, predicted: str) -> dict[str, Column]:
    """Additive parts of all metrics for one pair of columns."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    err = F.abs(a - p)
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("double")
    return {
        "s_n": F.count(a - p).cast("double"),
        "s_abs_err": F.sum(err),
        "s_abs_actual": F.sum(F.abs(a)),
        "s_sq_err": F.sum(F.pow(a - p, 2)),
        "s_tp": flag((a > 0) & (p > 0)),
        "s_fp": flag((a <= 0) & (p > 0)),
        "s_fn": flag((a > 0) & (p <= 0)),
        "s_ape_skip": F.sum(F.when(a != 0, err / F.nullif(F.abs(a), F.lit(0.0)))),
        "s_n_skip": flag(a != 0),
        "s_ape_mask": F.sum(F.when(F.abs(a) > MAPE_MASK, err / F.nullif(F.abs(a), F.lit(0.0)))),
        "s_n_mask": flag(F.abs(a) > MAPE_MASK),
        "s_ape_one": F.sum(err / F.when(a == 0, F.lit(1.0)).otherwise(F.abs(a))),
    }


def wape() -> Column:
    return F.col("s_abs_err") / F.greatest(F.col("s_abs_actual"), F.lit(EPS))


def rmse() -> Column:
    return F.sqrt(F.try_divide(F.col("s_sq_err"), F.col("s_n")))


def mae() -> Column:
    return F.try_divide(F.col("s_abs_err"), F.col("s_n"))


def f1_binary() -> Column:
    """F1 of "sells at all": precision and recall with epsilon guards."""
    precision = F.col("s_tp") / F.greatest(F.col("s_tp") + F.col("s_fp"), F.lit(EPS))
    recall = F.col("s_tp") / F.greatest(F.col("s_tp") + F.col("s_fn"), F.lit(EPS))
    return 2.0 * precision * recall / F.greatest(precision + recall, F.lit(EPS))


def mape(zero: str = "skip") -> Column:
    """Percentage error; ``zero`` says what happens to zero actuals: ``skip``, ``mask`` (tiny ones too) or ``one``."""
    if zero == "skip":
        return 100.0 * F.try_divide(F.col("s_ape_skip"), F.col("s_n_skip"))
    if zero == "mask":
        return 100.0 * F.try_divide(F.col("s_ape_mask"), F.col("s_n_mask"))
    if zero == "one":
        return 100.0 * F.try_divide(F.col("s_ape_one"), F.col("s_n"))
    raise ValueError(f"unknown zero rule: {zero}")


def monitored() -> dict[str, Column]:
    """The metrics of the performance tables."""
    return {"wape": wape(), "rmse": rmse(), "mae": mae(), "f1_binary": f1_binary()}
