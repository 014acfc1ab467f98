"""Monitored columns, bin edges, histograms and segment shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastops.operators.joins import null_safe_join
from forecastops.operators.ranking import quantiles
from forecastops.session import cut, small_side

BINS = 20
#: distinct values from which a column gets quantile bins
HIGH_CARDINALITY = 20
#: A column whose rough distinct count exceeds this many times the limit is not counted exactly; the rough count is off by
#: a few per cent, so the factor leaves a wide margin.
ROUGH_MARGIN = 10
_INF = float("inf")


def _names(seg: str | Sequence[str]) -> list[str]:
    return [seg] if isinstance(seg, str) else list(seg)


def unpivot_features(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (ids, feature, value) without nulls."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), "feature", "value").where("value is not null")


def monitored_columns(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Numeric columns with more than two distinct values, as ``{"low": [...], "high": [...]}``.

    One pass of mergeable counters settles all columns that are far from the limits; only columns with few values are
    counted exactly, which costs little because few values survive the map side.
    """
    out_of = {c.lower() for c in exclude}
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name.lower() not in out_of]
    if not numeric:
        return {"low": [], "high": []}
    rough = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in numeric]).first()
    near = [c for c in numeric if rough[c] <= ROUGH_MARGIN * HIGH_CARDINALITY]
    counts = df.agg(*[F.countDistinct(c).alias(c) for c in near]).first().asDict() if near else {}
    low = [c for c in near if 2 < counts[c] < HIGH_CARDINALITY]
    return {"low": low, "high": [c for c in numeric if c not in near or counts[c] >= HIGH_CARDINALITY]}


def classify_columns(df: DataFrame, exclude: Sequence[str] = (), categorical: Sequence[str] = ()) -> dict[str, list[str]]:
    """Columns by use: ``excluded``, ``categorical`` (listed, or not numeric) and ``numeric``."""
    out_of, named = ({c.lower() for c in cs} for cs in (exclude, categorical))
    out: dict[str, list[str]] = {"excluded": [], "categorical": [], "numeric": []}
    for f in df.schema:
        numeric = isinstance(f.dataType, T.NumericType) and f.name.lower() not in named
        kind = "excluded" if f.name.lower() in out_of else "numeric" if numeric else "categorical"
        out[kind].append(f.name)
    return out


def low_edges(df: DataFrame, seg: str, columns: Sequence[str]) -> DataFrame:
    """(seg, feature, edges): midpoints between consecutive distinct values of a segment.

    A column constant within a segment has no edge and no row.
    """
    values = unpivot_features(df, [seg], columns).where(~F.isnan("value")).distinct()
    w = Window.partitionBy(seg, "feature").orderBy("value")
    middle = ((F.col("value") + F.lead("value").over(w)) / 2.0).alias("edge")
    return (
        values.select(seg, "feature", middle)
        .where("edge is not null")
        .groupBy(seg, "feature")
        .agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    )


def high_edges(df: DataFrame, seg: str, columns: Sequence[str], bins: int = BINS, exact: bool = False) -> DataFrame:
    """(seg, feature, edges): the ``bins - 1`` inner quantiles per segment and column."""
    probs = [i / bins for i in range(1, bins)]
    if exact:
        long = unpivot_features(df, [seg], columns)
        return quantiles(long, [seg, "feature"], "value", probs).withColumnRenamed("qs", "edges")
    asked = F.array(*[F.lit(p) for p in probs])
    finite = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    wide = df.groupBy(seg).agg(*[F.percentile_approx(finite(c), asked, 10_000).alias(c) for c in columns])
    return wide.unpivot([seg], list(columns), "feature", "edges").where("edges is not null")


def bin_edges(
    df: DataFrame, seg: str, low: Sequence[str], high: Sequence[str], bins: int = BINS, exact: bool = False
) -> DataFrame:
    """Edge arrays of all monitored columns, each by the rule of its class; computed once, as every histogram uses them."""
    parts = []
    if low:
        parts.append(low_edges(df, seg, low))
    if high:
        parts.append(high_edges(df, seg, high, bins, exact))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut(out)


def edges_to_bins(edges: DataFrame, seg: str | Sequence[str]) -> DataFrame:
    """Rows (seg, feature, bin, bin_low, bin_high): half-open bins numbered from 1, open at both ends."""
    seg = _names(seg)
    low = F.concat(F.array(F.lit(-_INF)), F.col("edges"))
    high = F.concat(F.col("edges"), F.array(F.lit(_INF)))
    return edges.select(*seg, "feature", F.posexplode(F.arrays_zip(low.alias("low"), high.alias("high"))).alias("pos", "b")).select(
        *seg,
        "feature",
        (F.col("pos") + 1).cast("int").alias("bin"),
        F.col("b.low").alias("bin_low"),
        F.col("b.high").alias("bin_high"),
    )


def bins_to_edges(bins: DataFrame, seg: str | Sequence[str]) -> DataFrame:
    """Edge arrays back from stored bin rows (of a baseline)."""
    seg = _names(seg)
    inner = bins.select(*seg, "feature", "bin", "bin_low").distinct().where(F.col("bin_low") > -_INF)
    return inner.groupBy(*seg, "feature").agg(F.sort_array(F.collect_list("bin_low")).alias("edges"))


def bin_of(value: Column, edges: Column) -> Column:
    """Number of the half-open bin holding ``value``; null for null, NaN and +inf, which no bin holds.

    Counting the edges at or below the value gives the same bin as a join on ``low <= value < high``, also where
    quantiles coincide, without a row per candidate bin.
    """
    v = value.cast("double")
    at = F.size(F.filter(edges, lambda e: e <= v)) + 1
    return F.when(v.isNotNull() & ~F.isnan(v) & (v < _INF) & edges.isNotNull(), at)


def histogram(
    df: DataFrame, time: Sequence[str], seg: str | Sequence[str], columns: Sequence[str], edges: DataFrame
) -> DataFrame:
    """Rows per (time, segment, feature, bin), every time present with every bin, empty bins 0.

    ``seg`` is one column or several. Each input row meets one row of edges (its segment's) and is folded into bin counts
    on the map side; neither raw nor exploded rows are shuffled, unless the edges are too large to be broadcast. ``edges``
    is read three times: a stored or otherwise cheap frame. A null segment or time is one like any other.
    """
    seg = _names(seg)
    per_segment = small_side(
        edges.groupBy(*seg).agg(*[F.max(F.when(F.col("feature") == c, F.col("edges"))).alias(f"_e_{c}") for c in columns])
    )
    binned = null_safe_join(df.select(*time, *seg, *columns), per_segment, seg)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(F.col(c), F.col(f"_e_{c}")).alias("bin")) for c in columns])
    counts = (
        binned.select(*time, *seg, F.explode(cells).alias("c"))
        .where("c.bin is not null")
        .groupBy(*time, *seg, F.col("c.feature").alias("feature"), F.col("c.bin").alias("bin"))
        .agg(F.count(F.lit(1)).alias("bin_count"))
    )
    times = df.select(F.struct(*time).alias("t")).distinct().agg(F.collect_list("t")).scalar()
    scaffold = edges_to_bins(edges, seg).withColumn("t", F.explode(times)).select(
        *[F.col(f"t.{c}").alias(c) for c in time], *seg, "feature", "bin", "bin_low", "bin_high"
    )
    return null_safe_join(scaffold, counts, [*time, *seg, "feature", "bin"], "left").na.fill(0, ["bin_count"])


def unmonitored(production: DataFrame, seg: str, columns: Sequence[str], edges: DataFrame) -> DataFrame:
    """(seg, feature, reason) of the pairs of ``production`` that no histogram covers.

    ``new segment``: the baseline has no edges for the segment at all; ``no edges``: none for this feature, as it is
    constant or null there in the baseline.
    """
    pairs = production.select(seg).distinct().withColumn("feature", F.explode(F.array(*[F.lit(c) for c in columns])))
    known = edges.select(F.col(seg).alias("_seg")).distinct().withColumn("_known", F.lit(True))
    open_pairs = pairs.join(edges.select(F.col(seg).alias("_s"), F.col("feature").alias("_f")), F.col(seg).eqNullSafe(F.col("_s")) & (F.col("feature") == F.col("_f")), "left_anti")
    joined = open_pairs.join(known, F.col(seg).eqNullSafe(F.col("_seg")), "left")
    return joined.select(seg, "feature", F.when(F.col("_known"), "no edges").otherwise("new segment").alias("reason"))


def proportions(df: DataFrame, time: Sequence[str], seg: str) -> DataFrame:
    """Rows per (time, segment) and their share of the time's rows; the window runs over the counts."""
    counts = df.groupBy(*time, seg).agg(F.count(F.lit(1)).alias("bin_count"))
    return counts.withColumn("bin_prop", F.col("bin_count") / F.sum("bin_count").over(Window.partitionBy(*time)))


def category_shares(df: DataFrame, time: Sequence[str], seg: str, columns: Sequence[str]) -> DataFrame:
    """Histogram of categorical columns in the same shape: the category takes the place of the bin."""
    long = df.select(*time, seg, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [*time, seg], list(columns), "feature", "bin"
    )
    return long.where("bin is not null").groupBy(*time, seg, "feature", "bin").agg(F.count(F.lit(1)).alias("bin_count"))
