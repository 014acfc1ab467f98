"""Purchase-pattern groups, statistic groups, 16-way and six-way segmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.functions.calendar import week_start
from forecastops.operators.ranking import add_ntile, quantiles
from forecastops.session import lookup

# Names of the six segments and of the statistic groups.
SEGMENT_TEXT = {
    "SEGMENT_1": "High Frequency - High Volume",
    "SEGMENT_2": "High Frequency - Med-High Volume",
    "SEGMENT_3": "Medium Frequency - High Volume",
    "SEGMENT_4": "Medium Frequency - Low-Med Volume",
    "SEGMENT_5": "Low Frequency - Any Volume",
    "SEGMENT_6": "Inactive/Sporadic",
}
STATS_PREFIX = "group_stat_"
NO_SALES = "0000"


def pattern_group(df: DataFrame, lags: Sequence[str] = ("w_m1_total", "w_m2_total", "w_m3_total", "w_m4_total")) -> DataFrame:
    """Four-bit pattern of weeks with sales (most recent first) as ``group``; rows without any sales are dropped."""
    bits = [F.col(c).cast("boolean").cast("int").cast("string") for c in lags]
    return df.withColumn("group", F.concat(*bits)).where(F.col("group") != NO_SALES)


def stats_group_by_quartile(df: DataFrame, y: str, exact: bool = False) -> DataFrame:
    """Training rule: which of the target's quartiles within the pattern are positive decides the statistic group.

    There are at most 15 patterns. Three positive quartiles give group 3, none gives 0; a combination that is not
    monotone has no group.
    """
    q = quantiles(df, ["group"], y, [0.25, 0.5, 0.75], exact=exact, accuracy=1000)
    positive = [F.get("qs", F.lit(i)) > 0 for i in range(3)]
    zero = [F.get("qs", F.lit(i)) == 0 for i in range(3)]
    rule = None
    for n in range(4):
        matches = positive[3 - n :] + zero[: 3 - n]
        cond = matches[0]
        for m in matches[1:]:
            cond = cond & m
        label = F.lit(f"{STATS_PREFIX}{n}")
        rule = F.when(cond, label) if rule is None else rule.when(cond, label)
    return df.join(lookup(q.select("group", rule.alias("stats_group"))), "group")


def stats_group_by_activity(df: DataFrame) -> DataFrame:
    """Inference rule: the number of active weeks in the pattern, less one."""
    active = F.length(F.replace(F.col("group"), F.lit("0"), F.lit("")))
    return df.withColumn("stats_group", F.concat(F.lit(STATS_PREFIX), (active - 1).cast("string")))


def ntile_group(df: DataFrame, value: str, ids: Sequence[str], tiles: int = 4) -> DataFrame:
    """``stats_ntile_group``: statistic group and the quartile of ``value`` within it, ties ordered by ``ids``."""
    ranked = add_ntile(df, ["stats_group"], [value, *ids], tiles, "percentile_group")
    return ranked.withColumn("stats_ntile_group", F.concat_ws("_", "stats_group", "percentile_group"))


def customer_category(flags: Sequence[tuple[str, str]], default: str) -> Column:
    """First label whose flag column is 1, else the default."""
    out = F.lit(default)
    for column, label in reversed(flags):
        out = F.when(F.col(column) == 1, F.lit(label)).otherwise(out)
    return out


def six_way_segments(tx: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Six customer segments from the purchase pattern of the last four selling weeks and the volume quartile.

    One aggregate per customer against a list of at most four weeks takes the place of a customers x weeks scaffold.
    """
    recent = tx.withColumn("_week", week_start("tx_date")).where(F.col("tx_date") >= F.date_sub(as_of, 56))
    last = (
        recent.where(F.col("tx_date") >= F.date_sub(as_of, 28)).select("_week").distinct().orderBy(F.desc("_week")).limit(4)
    )
    weeks = last.agg(F.sort_array(F.collect_list("_week"))).scalar()
    sold = [F.sum(F.when(F.col("_week") == F.get(F.col("_weeks"), F.lit(i)), F.col("units"))) for i in range(4)]
    per_customer = (
        recent.withColumn("_weeks", weeks)
        .groupBy("customer_id")
        .agg(*[s.alias(f"_u{i}") for i, s in enumerate(sold)])
    )
    bought = [F.when(F.col(f"_u{i}") > 0, 1).otherwise(0) for i in range(4)]
    shown = [F.when(F.get(F.col("_weeks"), F.lit(i)).isNotNull(), b.cast("string")) for i, b in enumerate(bought)]
    totals = (
        customers.select("customer_id")
        .join(per_customer, "customer_id", "left")
        .withColumn("_weeks", weeks)
        .select(
            "customer_id",
            sum((F.coalesce(F.col(f"_u{i}"), F.lit(0.0)) for i in range(1, 4)), F.coalesce(F.col("_u0"), F.lit(0.0))).alias(
                "total_units_4w"
            ),
            (bought[0] + bought[1] + bought[2] + bought[3]).alias("weeks_with_purchase"),
            F.concat_ws("", *shown).alias("purchase_pattern"),
        )
    )
    ranked = add_ntile(totals, [], ["total_units_4w", "customer_id"], 4, "volume_quartile")
    return ranked.withColumn("segment", segment_of("weeks_with_purchase", "volume_quartile")).withColumn(
        "segment_description", F.create_map(*[F.lit(x) for kv in SEGMENT_TEXT.items() for x in kv])[F.col("segment")]
    )


def segment_of(weeks: str, quartile: str) -> Column:
    w, q = F.col(weeks), F.col(quartile)
    return (
        F.when((w == 4) & (q == 4), "SEGMENT_1")
        .when((w == 4) & (q == 3), "SEGMENT_2")
        .when(w.isin(2, 3) & (q >= 3), "SEGMENT_3")
        .when(w.isin(2, 3) & (q <= 2), "SEGMENT_4")
        .when(w == 1, "SEGMENT_5")
        .otherwise("SEGMENT_6")
    )


def share_of_total(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Row count per group and its percentage of all rows (two decimals)."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("row_count"))
    whole = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("percentage", F.round(100.0 * F.col("row_count") / whole, 2))


def pattern_support(df: DataFrame, segment: str, pattern: str, least: int = 5) -> DataFrame:
    """Customers per (segment, pattern), patterns with less support than ``least`` left out."""
    return df.groupBy(segment, pattern).agg(F.count(F.lit(1)).alias("customer_count")).where(F.col("customer_count") >= least)
