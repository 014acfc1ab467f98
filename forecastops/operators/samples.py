"""Two-sample tests on values: Kolmogorov-Smirnov and Wasserstein distances, exact for samples of any size.

Both samples become counts per value, so a hot value is one row. The values are range-partitioned and sorted once; the
shares below each partition, and the value that follows it, are carried by a table of one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.operators.ranking import _placed
from forecastops.session import lookup

#: Terms of the Kolmogorov series.
TERMS = 100


def _p_value(distance: Column, na: Column, nb: Column) -> Column:
    """Chance of a Kolmogorov-Smirnov distance as large as this between samples of one distribution (asymptotic)."""
    size = F.sqrt(na * nb / (na + nb))
    x = distance * (size + 0.12 + 0.11 / size)
    term = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.lit(0.0), lambda s, k: s + term(k.cast("double")))
    return F.when(distance == 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


def two_sample(df: DataFrame, group: Sequence[str], value: str, side: Column) -> DataFrame:
    """(group, n_a, n_b, ks, wasserstein, p_value) of the values where ``side`` is true (a) against those where it is false.

    Nulls and NaN, and rows without side, are left out; infinite values count in ``ks`` and make ``wasserstein`` infinite
    where the shares differ up to them. A group with one sample only has null distances; a null group is a group.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v) & side.isNotNull()).select(*group, v.alias("_v"), side.alias("_a"))
    counts = rows.groupBy(*group, "_v").agg(F.count_if("_a").alias("_na"), F.count_if(~F.col("_a")).alias("_nb"))
    placed = _placed(counts, group, ["_v"])
    runs = placed.groupBy(*group, "_part").agg(F.sum("_na").alias("_pa"), F.sum("_nb").alias("_pb"), F.min("_v").alias("_first"))
    # one row per partition and group
    ahead = Window.partitionBy(*group).orderBy("_part")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    carried = runs.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_pa").over(before), F.lit(0)).alias("_ba"),
        F.coalesce(F.sum("_pb").over(before), F.lit(0)).alias("_bb"),
        F.sum("_pa").over(whole).alias("n_a"),
        F.sum("_pb").over(whole).alias("n_b"),
        F.lead("_first").over(ahead).alias("_next_first"),
    )
    match = [F.col("_part") == F.col("_p"), *[placed[g].eqNullSafe(F.col(f"_g_{g}")) for g in group]]
    in_part = Window.partitionBy(*group, "_part").orderBy("_v")
    upto = in_part.rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.join(lookup(carried), match).drop("_p", *[f"_g_{g}" for g in group])
    fa = F.try_divide(F.col("_ba") + F.sum("_na").over(upto), F.col("n_a"))
    fb = F.try_divide(F.col("_bb") + F.sum("_nb").over(upto), F.col("n_b"))
    gap = F.abs(fa - fb)
    rows = rows.withColumns({"_gap": gap, "_next": F.coalesce(F.lead("_v").over(in_part), "_next_first")})
    area = F.when(F.col("_gap") > 0, F.col("_gap") * (F.col("_next") - F.col("_v"))).when(F.col("_gap") == 0, 0.0)
    out = rows.groupBy(*group).agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.max("_gap").alias("ks"), F.sum(area).alias("wasserstein"))
    both = F.col("ks").isNotNull()
    return out.withColumns({"wasserstein": F.when(both, F.col("wasserstein")), "p_value": F.when(both, _p_value(F.col("ks"), F.col("n_a"), F.col("n_b")))})
