"""Week and month arithmetic. The period key is an integer YYYYWW."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_week(date: str | Column) -> Column:
    """ISO year * 100 + ISO week."""
    d = _col(date)
    return (F.date_part(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("int")


def week_start(date: str | Column) -> Column:
    """Monday of the week of a date."""
    return F.date_trunc("week", _col(date)).cast("date")


def week_to_date(week: str | Column) -> Column:
    """Landing date of a period: 1 January of the year plus (week - 1) weeks."""
    w = _col(week).cast("int")
    return F.date_add(F.make_date(F.floor(w / 100).cast("int"), F.lit(1), F.lit(1)), (w % 100 - 1) * 7)


def iso_week_monday(week: str | Column) -> Column:
    """Monday of an ISO period: the Monday of the week with 4 January, plus (week - 1) weeks."""
    w = _col(week).cast("int")
    fourth = F.make_date(F.floor(w / 100).cast("int"), F.lit(1), F.lit(4))
    return F.date_add(F.date_trunc("week", fourth).cast("date"), (w % 100 - 1) * 7)


def calmonth(date: str | Column) -> Column:
    return F.date_format(_col(date), "yyyyMM")


def day_of_week(date: str | Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_col(date)) - 1


def local_time(ts: str | Column, zone: str) -> Column:
    """Wall-clock time of a UTC instant in a zone (a region name or an offset), as a timestamp without zone."""
    return F.from_utc_timestamp(_col(ts), zone).cast("timestamp_ntz")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day with its ISO week, the following ISO week and the calendar month."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_d"))
    return days.select(
        "date_d",
        iso_week("date_d").alias("iso_week"),
        iso_week(F.date_add("date_d", 7)).alias("iso_week_next"),
        calmonth("date_d").alias("calmonth"),
        F.date_format("date_d", "yyyyMMdd").alias("date_key"),
    )


def weeks_after(cutoffs: DataFrame, cutoff: str, weeks: int) -> DataFrame:
    """Distinct ISO weeks that start the ``weeks`` weeks following each cut-off date, one row per (row, week)."""
    end = F.date_sub(F.date_add(F.col(cutoff), 7 * weeks), 1)
    return cutoffs.withColumn(
        "week",
        F.explode(F.array_distinct(F.transform(F.sequence(F.col(cutoff), end), iso_week))),
    )
