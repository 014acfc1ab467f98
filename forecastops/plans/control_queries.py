"""Registered queries: control charts in batch and on a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from forecastops.operators import control as co
from forecastops.plans.registry import query, with_
from forecastops.session import shared_folder
from forecastops.streaming import control as sc

IN_CONTROL_UNTIL = "2024-01-11"

CHART = [
    "v AS (SELECT event_type, CAST(ts AS DATE) AS day, AVG(value) AS value FROM events WHERE value IS NOT NULL GROUP BY 1, 2)",
    f"""s AS (SELECT *, AVG(value) FILTER (day < DATE '{IN_CONTROL_UNTIL}') OVER (PARTITION BY event_type) AS m,
          GREATEST(COALESCE(STDDEV_SAMP(value) FILTER (day < DATE '{IN_CONTROL_UNTIL}') OVER (PARTITION BY event_type), 0), {co.MIN_STD}) AS sd FROM v)""",
    "z AS (SELECT *, (value - m) / sd AS z, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY day) AS i FROM s)",
    # the CUSUM step by step
    f"""c AS (SELECT event_type, list_transform(range(1, len(l) + 1), lambda i: {{'day': l[i].day, 'value': l[i].value, 'z': l[i].z,
          'high': list_reduce(list_prepend(0.0::DOUBLE, list_transform(l[1:i], lambda x: x.z)), lambda a, x: greatest(a + x - {co.SLACK}, 0)),
          'low': list_reduce(list_prepend(0.0::DOUBLE, list_transform(l[1:i], lambda x: -x.z)), lambda a, x: greatest(a + x - {co.SLACK}, 0))}}) AS r
          FROM (SELECT event_type, list({{'day': day, 'value': value, 'z': z}} ORDER BY day) AS l FROM z GROUP BY 1))""",
    "u AS (SELECT event_type, UNNEST(r) AS r FROM c)",
]
CHART_SQL = with_(
    CHART,
    f"""SELECT r.day AS day, event_type, r.value AS value, r.z AS z, r.high AS cusum_high, r.low AS cusum_low,
          CAST(CASE WHEN ABS(r.z) >= {co.SIGMAS[1]} THEN 2 WHEN ABS(r.z) >= {co.SIGMAS[0]} THEN 1 ELSE 0 END AS INTEGER) AS sigma_level, r.high > {co.DECISION} OR r.low > {co.DECISION} AS shifted FROM u""",
)
_ROUNDED = "value z cusum_high cusum_low"


def _by_day(chart):
    return chart.select(F.to_date("window_start").alias("day"), *[c for c in chart.columns if c != "window_start"])


def _in_control():
    return F.col("window_start") < F.lit(IN_CONTROL_UNTIL).cast("timestamp")


@query("control_chart", CHART_SQL, _ROUNDED)
def control_chart(spark, sf):
    """Sigma levels and CUSUM of the daily mean of each event type."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    return _by_day(co.control_chart(co.window_values(events, "ts", ["event_type"], "value"), ["event_type"], _in_control()))


@query("control_chart_stream", CHART_SQL, _ROUNDED)
def control_chart_stream(spark, sf):
    """The same chart on a stream of files that arrive out of order, two of them after a restart."""
    root = f"{shared_folder(spark)}/control-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "event_type", "value")
    for part in range(2):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).repartition(2, "event_id").write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arrived")
        sc.watch(stream, root, "ts", ["event_type"], "value", delay="400 days")
    return _by_day(sc.chart(spark, root, ["event_type"], _in_control()))
