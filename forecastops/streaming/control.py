"""Control charts kept up to date by a stream of measured values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.operators.control import control_chart, window_values
from forecastops.streaming.monitor import land


def watch(stream: DataFrame, root: str, ts: str, keys: Sequence[str], value: str, *, window: str = "1 day", delay: str = "7 days") -> None:
    """Take up what has arrived, and stop.

    The state holds the sums of each (window, key) until the watermark passes it, so files may come out of order within
    ``delay``; rows later than that are dropped by the watermark. A micro-batch upserts the windows it touched into the
    partitions of their days, and a repeated one writes the same sums.
    """
    sums = window_values(stream, ts, keys, value, window, delay).withColumn("window_day", F.to_date("window_start"))
    land(sums, f"{root}/sums", f"{root}/checkpoint", ["window_start", *keys, "window_day"], ["window_day"])


def chart(spark: SparkSession, root: str, keys: Sequence[str], in_control: Column) -> DataFrame:
    """The control chart of all windows seen so far; see :func:`forecastops.operators.control.control_chart`."""
    return control_chart(spark.read.parquet(f"{root}/sums").drop("window_day"), keys, in_control)
