"""Panels, guarded lags, rolling windows and feature views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.functions.calendar import day_of_week, iso_week, iso_week_monday, week_start
from forecastops.operators.ranking import add_ntile
from forecastops.session import cut, lookup

# Season rules of the temporal and product views (months), and the activity levels (weeks with a
# purchase, highest first).
HOLIDAY_MONTHS = (12, 1, 3, 4, 9)
HIGH_SEASON_MONTHS, HIGH_SEASON = (12, 1, 6, 7), 1.3
MID_SEASON_MONTHS, MID_SEASON = (3, 4, 9, 10), 1.1
LOW_SEASON = 1.0
ACTIVITY_LEVELS = ((4, "VERY_ACTIVE"), (2, "ACTIVE"), (1, "MODERATE"))
INACTIVE = "INACTIVE"

# The rolling family of the model inputs, as (rows back, function).
ROLLING_FAMILY = (
    (2, "avg"), (2, "max"), (3, "avg"), (3, "max"),
    (4, "sum"), (4, "avg"), (4, "max"),
    (12, "sum"), (12, "avg"), (12, "max"),
    (24, "sum"), (24, "avg"), (24, "max"),
)
LAGS = 4


def weekly_panel(df: DataFrame, ids: Sequence[str], date: str, value: str) -> DataFrame:
    """One row per (ids, ISO week) with a sale; weeks without sales have no row."""
    return df.groupBy(*ids, iso_week(date).alias("week")).agg(F.sum(value).alias(value))


def weekly_rollup(tx: DataFrame, inference_from: Column | str) -> DataFrame:
    """Weekly sales per customer, split by training and inference period.

    Lines are first reduced to (customer, week, order) and (customer, week, product) by the distinct counts' own
    two-step plan; the sums ride along.
    """
    since = F.lit(inference_from).cast("date") if isinstance(inference_from, str) else inference_from
    return tx.groupBy(
        "customer_id", week_start("tx_date").alias("week_start_date"), (F.col("tx_date") >= since).alias("is_inference")
    ).agg(
        F.sum("units").alias("weekly_sales_units"),
        F.sum("revenue").alias("weekly_sales_revenue"),
        F.countDistinct("transaction_id").alias("transaction_count"),
        F.countDistinct("product_id").alias("unique_products_purchased"),
        F.avg("units").alias("mean_units"),
    )


def derive_revenue(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue of every line as units times the product's price."""
    prices = products.select("product_id", F.col("price").alias("_price"))
    return tx.join(prices, "product_id").withColumn("revenue", F.col("units") * F.col("_price")).drop("_price")


def ground_truth_sales(tx: DataFrame, days: DataFrame, day: str, products: DataFrame, ids: Sequence[str], value: str) -> DataFrame:
    """Sales of the given calendar days per ``ids`` (a product attribute among them), sums that are not positive left out."""
    sold = tx.join(days.select(F.col(day).alias("tx_date")).distinct(), "tx_date", "left_semi")
    return sold.join(products, "product_id").groupBy(*ids).agg(F.sum(value).alias(value)).where(F.col(value) > 0)


def _series(ids: Sequence[str], week: str):
    return Window.partitionBy(*ids).orderBy(week)


def _week_index(week: str) -> Column:
    return (F.datediff(iso_week_monday(week), F.lit("1970-01-05").cast("date")) / 7).cast("int")


def lag_columns(ids: Sequence[str], week: str, y: str, n: int = LAGS, calendar: bool = False) -> dict[str, Column]:
    w = _series(ids, week)
    at = _week_index(week) if calendar else F.col(week)
    return {
        f"w_m{k}_total": F.when(F.lag(at, k).over(w) == at - k, F.coalesce(F.lag(y, k).over(w), F.lit(0.0))).otherwise(0.0)
        for k in range(1, n + 1)
    }


def guarded_lags(df: DataFrame, ids: Sequence[str], week: str, y: str, n: int = LAGS, calendar: bool = False) -> DataFrame:
    """``w_m{k}_total``: the value k rows back if that row is exactly k periods back, else 0.

    The default compares YYYYWW numbers, which never matches across a year's end; ``calendar`` compares weeks on the
    calendar. The input is a panel (one row per ids and week), so a series is no longer than the calendar.
    """
    return df.withColumns(lag_columns(ids, week, y, n, calendar))


def rolling_name(k: int, fn: str) -> str:
    return f"{fn}_prev{k}" if k < 4 else f"{fn}_past_{k}_weeks"


def rolling_columns(ids: Sequence[str], week: str, y: str, family: Sequence[tuple[int, str]]) -> dict[str, Column]:
    fns = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}
    out = {}
    for k, fn in family:
        frame = _series(ids, week).rowsBetween(-k, -1)
        out[rolling_name(k, fn)] = F.when(F.count(y).over(frame) == k, fns[fn](y).over(frame)).otherwise(0.0)
    return out


def rolling(
    df: DataFrame, ids: Sequence[str], week: str, y: str, family: Sequence[tuple[int, str]] = ROLLING_FAMILY
) -> DataFrame:
    """Aggregates over the k preceding rows, 0 unless all k rows are there."""
    return df.withColumns(rolling_columns(ids, week, y, family))


def training_features(
    df: DataFrame,
    ids: Sequence[str],
    week: str,
    y: str,
    family: Sequence[tuple[int, str]] = ROLLING_FAMILY,
    calendar: bool = False,
) -> DataFrame:
    """Lags, rolling aggregates and their 4-week sum on one sort of the panel (no re-join of separate tables)."""
    wide = df.withColumns({**lag_columns(ids, week, y, LAGS, calendar), **rolling_columns(ids, week, y, family)})
    total = sum((F.col(f"w_m{k}_total") for k in range(2, LAGS + 1)), F.col("w_m1_total"))
    return wide.withColumns({"sum_p4w": total, "week_of_year": (F.col(week) % 100).cast("int")})


def materialise(
    df: DataFrame, drop: Sequence[str] = (), snapshot_id: str | None = None, snapshot_ts: Column | None = None
) -> DataFrame:
    """Feature table: all columns except ``drop`` (any letter case), with the snapshot it belongs to."""
    out_of = {c.lower() for c in drop}
    out = df.select(*[c for c in df.columns if c.lower() not in out_of])
    if snapshot_id is not None:
        out = out.withColumns({"snapshot_id": F.lit(snapshot_id), "snapshot_ts": F.current_timestamp() if snapshot_ts is None else snapshot_ts})
    return out


def temporal_view(df: DataFrame, date: str, since: Column | None = None) -> DataFrame:
    """One row per date that occurs: week, month, quarter, weekday (Sunday = 0), season and weekend flags."""
    dates = df.select(F.col(date).cast("date").alias("feature_date"))
    if since is not None:
        dates = dates.where(F.col("feature_date") >= since)
    d, month, dow = F.col("feature_date"), F.month("feature_date"), day_of_week("feature_date")
    return dates.distinct().select(
        "feature_date",
        F.weekofyear(d).alias("week_of_year"),
        month.alias("month"),
        F.quarter(d).alias("quarter"),
        dow.alias("day_of_week"),
        F.when(month.isin(*HOLIDAY_MONTHS), 1).otherwise(0).alias("is_holiday_season"),
        F.when(dow.isin(0, 6), 1).otherwise(0).alias("is_weekend"),
    )


def activity_level(weeks: str | Column) -> Column:
    c = F.col(weeks) if isinstance(weeks, str) else weeks
    out = F.when(c >= ACTIVITY_LEVELS[0][0], ACTIVITY_LEVELS[0][1])
    for least, label in ACTIVITY_LEVELS[1:]:
        out = out.when(c >= least, label)
    return out.otherwise(INACTIVE)


def _daily(tx: DataFrame) -> DataFrame:
    """Sums per customer and day: fewer rows to hand to look-back windows."""
    return tx.groupBy("customer_id", "tx_date").agg(
        F.sum("revenue").alias("_revenue"),
        F.count("revenue").alias("_n_revenue"),
        F.sum("units").alias("_units"),
        F.count("units").alias("_n_units"),
    )


def _behaviour(window: DataFrame) -> DataFrame:
    """Aggregates of daily sums (customer_id, feature_ts, tx_date) over look-back windows of any length.

    Days are one row each, so counting them is plain; weeks are counted where a week's first day in the window is met.
    """
    weekly = window.groupBy("customer_id", "feature_ts", week_start("tx_date").alias("_week")).agg(
        *[F.sum(c).alias(c) for c in ("_revenue", "_n_revenue", "_units", "_n_units")],
        F.count(F.lit(1)).alias("_days"),
        F.max("tx_date").alias("_last"),
    )
    return weekly.groupBy("customer_id", "feature_ts").agg(
        F.try_divide(F.sum("_revenue"), F.sum("_n_revenue")).alias("mean_revenue"),
        F.count(F.lit(1)).alias("active_weeks"),
        F.datediff("feature_ts", F.max("_last")).alias("idle_days"),
        F.sum("_units").alias("units_in_window"),
        F.sum("_days").alias("active_days"),
        F.try_divide(F.sum("_units"), F.sum("_n_units")).alias("mean_units"),
    )


def _ranked_behaviour(seen: DataFrame, group: Sequence[str]) -> DataFrame:
    ranked = add_ntile(seen, group, ["units_in_window", "customer_id"], 4, "volume_quarter")
    return ranked.withColumn("activity_level", activity_level("active_weeks"))


def customer_view(tx: DataFrame, as_of: Column, days: int = 28) -> DataFrame:
    """Customer behaviour over the ``days`` up to ``as_of``: amounts, frequency, recency, volume quartile, activity."""
    window = tx.where((F.col("tx_date") >= F.date_sub(as_of, days)) & (F.col("tx_date") <= as_of))
    return _ranked_behaviour(_behaviour(_daily(window).withColumn("feature_ts", as_of)), [])


def _exit(date: Column, days: int) -> Column:
    """The first Monday whose look-back of ``days`` no longer covers ``date``."""
    return F.date_add(week_start(F.date_add(date, days)), 7)


def _look_back(tx: DataFrame, days: int) -> DataFrame:
    """Behaviour of each customer at every Monday whose look-back is not empty, by entries and exits.

    A week's days enter at the next Monday and leave at one of two later ones, so a customer has at most three events a week
    whatever the length of the window. Running sums of events hold until the customer's next event. Amounts are summed as
    whole millionths in longs, so that what leaves takes away exactly what it brought; a sum beyond 9.2e12 stops the job.
    """
    sums = ("_revenue", "_n_revenue", "_units", "_n_units", "_days")
    amounts = ("_revenue", "_units")
    exact = lambda c: F.coalesce(F.round(F.col(c) * 1_000_000) if c in amounts else F.col(c), F.lit(0)).cast("long")
    daily = _daily(tx).withColumn("_days", F.lit(1)).withColumns({"_week": week_start("tx_date"), "_out": _exit(F.col("tx_date"), days)})
    # the days of a week leave at the exit of its first day or a week later
    late = F.col("_out") > _exit(F.col("_week"), days)
    weekly = daily.groupBy("customer_id", "_week").agg(
        *[F.sum(exact(c)).alias(c) for c in sums], *[F.sum(F.when(late, exact(c)).otherwise(0)).alias(f"{c}_late") for c in sums], F.max("tx_date").alias("_last")
    )
    first = _exit(F.col("_week"), days)
    all_late = F.col("_days_late") > 0
    event = lambda at, weeks, parts, last: F.struct(at.alias("feature_ts"), weeks.cast("int").alias("_weeks"), *[p.cast("long").alias(c) for c, p in zip(sums, parts)], last.alias("_last"))
    nothing = F.lit(None).cast("date")
    events = F.array(
        event(F.date_add("_week", 7), F.lit(1), [F.col(c) for c in sums], F.col("_last")),
        event(first, F.when(all_late, 0).otherwise(-1), [F.col(f"{c}_late") - F.col(c) for c in sums], nothing),
        event(F.date_add(first, 7), F.when(all_late, -1).otherwise(0), [-F.col(f"{c}_late") for c in sums], nothing),
    )
    # a written week takes some fifty times its bytes in memory once its events are summed and sorted, so small partitions
    # are not joined to the size that suits other shuffles: a given number of them is left as it is
    spread = int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = weekly.repartition(spread, "customer_id").select("customer_id", F.inline(events))
    at = moved.groupBy("customer_id", "feature_ts").agg(*[F.sum(c).alias(c) for c in ("_weeks", *sums)], F.max("_last").alias("_last"))
    in_order = Window.partitionBy("customer_id").orderBy("feature_ts")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    state = at.select(
        "customer_id",
        "feature_ts",
        *[F.sum(c).over(upto).alias(c) for c in ("_weeks", *sums)],
        F.max("_last").over(upto).alias("_last"),
        F.lead("feature_ts").over(in_order).alias("_next"),
    )
    mondays = F.sequence(F.col("feature_ts"), F.date_sub("_next", 7), F.expr("INTERVAL 7 DAYS"))
    held = state.where("_days > 0").withColumn("feature_ts", F.explode(mondays))
    amount = lambda c: F.col(c) / F.lit(1e6)
    return held.select(
        "customer_id",
        "feature_ts",
        F.try_divide(amount("_revenue"), F.col("_n_revenue")).alias("mean_revenue"),
        F.col("_weeks").cast("bigint").alias("active_weeks"),
        F.datediff("feature_ts", "_last").alias("idle_days"),
        F.when(F.col("_n_units") > 0, amount("_units")).alias("units_in_window"),
        F.col("_days").cast("bigint").alias("active_days"),
        F.try_divide(amount("_units"), F.col("_n_units")).alias("mean_units"),
    )


def customer_view_pit(tx: DataFrame, days: int = 28) -> DataFrame:
    """Customer behaviour at every week start that has transactions, from the ``days`` before that Monday, seven at least.

    ``ts - days <= date < ts``; amounts are exact to a millionth. The cost follows the customers' selling weeks and the rows
    of the result, not the length of the window.
    """
    if days < 7:
        raise ValueError("a look-back of less than a week leaves days out")
    spine = lookup(tx.select(week_start("tx_date").alias("feature_ts")).distinct())
    return _ranked_behaviour(_look_back(tx, days).join(spine, "feature_ts", "left_semi"), ["feature_ts"])


def product_view(tx: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Product trend features at ``as_of``: last 4 weeks, the 4 before (sharing one day), season and category share.

    The transactions are scanned once; category totals come from the per-product sums.
    """
    t = tx.withColumn("feature_ts", as_of).where(
        (F.col("tx_date") >= F.date_sub("feature_ts", 56)) & (F.col("tx_date") <= F.col("feature_ts"))
    )
    age = F.datediff("feature_ts", "tx_date")
    recent = F.when(age <= 28, F.col("units"))
    daily = t.groupBy("product_id", "feature_ts", "tx_date").agg(
        F.sum(recent).alias("u4"), F.max(age <= 28).alias("recent"), F.sum(F.when(age >= 28, F.col("units"))).alias("u58")
    )
    per_product = daily.groupBy("product_id").agg(F.sum("u4").alias("u4"), F.count_if("recent").alias("days4"), F.sum("u58").alias("u58"))
    # one row per product, written once: the categories and their total are read from it
    base = cut(products.join(per_product, "product_id", "left"))
    per_category = base.groupBy("category").agg(F.sum("u4").alias("category_units"), F.count(F.lit(1)).alias("members"))
    # every product row carries its category's units, so a category counts once per product in the total
    whole = per_category.agg(F.sum(F.col("category_units") * F.col("members")).alias("t"))
    u4, u58 = F.coalesce("u4", F.lit(0.0)), F.coalesce("u58", F.lit(0.0))
    month = F.month("feature_ts")
    return (
        base.join(per_category, "category", "left")
        .withColumn("feature_ts", as_of)
        .select(
            "product_id",
            "feature_ts",
            u4.alias("units_last_4_weeks"),
            F.coalesce(F.try_divide("u4", "days4"), F.lit(0.0)).alias("avg_daily_units"),
            F.when(u58 == 0, 0.0).otherwise(F.try_divide(u4 - u58, u58)).alias("product_trend_last_4_weeks"),
            F.when(month.isin(*HIGH_SEASON_MONTHS), HIGH_SEASON)
            .when(month.isin(*MID_SEASON_MONTHS), MID_SEASON)
            .otherwise(LOW_SEASON)
            .alias("seasonal_demand_factor"),
            F.try_divide(F.col("category_units"), whole.scalar()).alias("category_performance_score"),
            "category",
            "price",
        )
    )


def training_rows(weekly: DataFrame, segments: DataFrame, as_of: Column, weeks: int = 52) -> DataFrame:
    """Weekly training rows of the last ``weeks`` weeks with their customer's segment and calendar parts."""
    recent = weekly.where(~F.col("is_inference") & (F.col("week_start_date") >= F.date_sub(as_of, 7 * weeks)))
    return recent.join(segments, "customer_id").withColumns(
        {
            "week_of_year": F.weekofyear("week_start_date"),
            "month": F.month("week_start_date"),
            "quarter": F.quarter("week_start_date"),
        }
    )
