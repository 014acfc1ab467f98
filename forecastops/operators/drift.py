"""Drift measures between a baseline and production distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.operators.histograms import bin_edges, category_shares, histogram
from forecastops.operators.joins import null_safe_join

EPS = 1e-10
# Fixed values: (warning, critical) limits, compared strictly.
PSI_LIMITS = (0.1, 0.2)
JS_LIMITS = (0.2, 0.45)


def threshold_alert(value: str | Column, limits: tuple[float, float]) -> Column:
    """2 above the critical limit, 1 above the warning limit, else 0."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v > limits[1], 2).when(v > limits[0], 1).otherwise(0)


def _floor(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(EPS))


def baseline_shares(base: DataFrame, seg: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean share of each segment over the baseline's times (per ``keys``, such as the model version)."""
    return base.groupBy(*keys, seg).agg(F.avg("bin_prop").alias("base_prop"))


def psi(
    production: DataFrame,
    base: DataFrame,
    seg: str,
    time: Sequence[str],
    *,
    keys: Sequence[str] = (),
    missing: str = "ignore",
    limits: tuple[float, float] = PSI_LIMITS,
) -> DataFrame:
    """Population stability index of each time's segment shares against the baseline's mean shares.

    ``missing="ignore"`` leaves out segments present on one side only; ``"zero"`` counts them with share 0. ``keys`` are
    the columns shared by both sides besides the segment (the model version). A null segment is one like any other.
    """
    means = baseline_shares(base, seg, keys)
    if missing == "zero":
        cells = production.select(*time).distinct()
        wanted = null_safe_join(cells, means.select(*keys, seg), list(keys)) if keys else _each(cells, means, seg)
        wanted = wanted.unionByName(production.select(*time, seg)).distinct()
        rows = null_safe_join(null_safe_join(wanted, production.select(*time, seg, "bin_prop"), [*time, seg], "left"), means, [*keys, seg], "left")
    else:
        rows = null_safe_join(production, means, [*keys, seg])
    q, p = _floor(F.col("bin_prop")), _floor(F.col("base_prop"))
    out = rows.groupBy(*time).agg(F.sum((q - p) * F.ln(q / p)).alias("psi"))
    return out.withColumn("alert_level", threshold_alert("psi", limits))


def _each(cells: DataFrame, means: DataFrame, seg: str) -> DataFrame:
    segments = means.agg(F.collect_set(F.struct(F.col(seg).alias("s")))).scalar()
    return cells.withColumn("_seg", F.explode(segments)).select("*", F.col("_seg.s").alias(seg)).drop("_seg")


def bin_probabilities(hist: DataFrame, time: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Counts as shares of their (time, dims) cell; an empty cell gives null shares."""
    total = F.sum("bin_count").over(Window.partitionBy(*time, *dims))
    return hist.withColumn("prob", F.try_divide(F.col("bin_count").cast("double"), total.cast("double")))


def baseline_probabilities(hist: DataFrame, time: Sequence[str], dims: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean share of each bin over the baseline's times; times without rows count as share 0."""
    probs = bin_probabilities(hist, [*keys, *time], dims)
    return probs.groupBy(*keys, *dims, "bin").agg(F.avg(F.coalesce("prob", F.lit(0.0))).alias("p"))


def paired_bins(
    production: DataFrame, base: DataFrame, time: Sequence[str], dims: Sequence[str], base_time: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """(time, dims, bin, p, q): baseline and production share of every bin that either side has.

    Cells are made from the production times and the baseline's bins, so that a bin without production rows keeps its
    time. ``time`` contains ``keys``, the columns (model version) on which production and baseline must agree.
    """
    q = bin_probabilities(production, time, dims).select(*time, *dims, "bin", F.col("prob").alias("q"))
    p = baseline_probabilities(base, base_time, dims, keys)
    cells = null_safe_join(q.select(*time, *dims).distinct(), p, [*keys, *dims])
    return null_safe_join(cells, q, [*time, *dims, "bin"], "full").select(
        *time, *dims, "bin", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q")
    )


def js_distance(
    production: DataFrame,
    base: DataFrame,
    time: Sequence[str],
    dims: Sequence[str],
    *,
    base_time: Sequence[str] = ("week",),
    keys: Sequence[str] = (),
    limits: tuple[float, float] = JS_LIMITS,
) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) of each time's histogram from the baseline's mean histogram."""
    p, q = _floor(F.col("p")), _floor(F.col("q"))
    m = (p + q) / 2.0
    out = paired_bins(production, base, time, dims, base_time, keys).groupBy(*time, *dims).agg(
        F.sqrt(0.5 * F.sum(p * F.ln(p / m)) + 0.5 * F.sum(q * F.ln(q / m))).alias("js_distance")
    )
    return out.withColumn("alert_level", threshold_alert("js_distance", limits))


def kl_divergence(
    production: DataFrame, base: DataFrame, time: Sequence[str], dims: Sequence[str], *, base_time: Sequence[str] = ("week",), keys: Sequence[str] = ()
) -> DataFrame:
    """Kullback-Leibler divergence of each time's histogram from the baseline: sum of q ln(q / p)."""
    p, q = _floor(F.col("p")), _floor(F.col("q"))
    return (
        paired_bins(production, base, time, dims, base_time, keys)
        .groupBy(*time, *dims)
        .agg(F.sum(q * F.ln(q / p)).alias("kl_divergence"))
    )


def distribution_tests(
    production: DataFrame, base: DataFrame, time: Sequence[str], dims: Sequence[str], *, base_time: Sequence[str] = ("week",), keys: Sequence[str] = ()
) -> DataFrame:
    """Kolmogorov-Smirnov and Wasserstein distance over the bins, in bin numbers: max and sum of |CDF difference|."""
    w = Window.partitionBy(*time, *dims).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(F.sum(F.col("q") - F.col("p")).over(w))
    cells = paired_bins(production, base, time, dims, base_time, keys).withColumn("_gap", gap)
    return cells.groupBy(*time, *dims).agg(F.max("_gap").alias("ks_distance"), F.sum("_gap").alias("wasserstein_bins"))


def chi_square(reference: DataFrame, analysis: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Chi-square statistic and Cramer's V of two count histograms (dims, bin, bin_count) per ``dims``."""
    both = (
        reference.groupBy(*dims, "bin").agg(F.sum("bin_count").alias("r"))
        .join(analysis.groupBy(*dims, "bin").agg(F.sum("bin_count").alias("a")), [*dims, "bin"], "full")
        .na.fill(0, ["r", "a"])
    )
    w = Window.partitionBy(*dims)
    tr, ta = F.sum("r").over(w).cast("double"), F.sum("a").over(w).cast("double")
    seen = F.col("r") + F.col("a")
    expected = lambda t: F.try_divide(seen * t, tr + ta)
    part = lambda o, e: F.coalesce(F.try_divide(F.pow(o - e, 2), e), F.lit(0.0))
    cells = both.withColumn("_x", part(F.col("r"), expected(tr)) + part(F.col("a"), expected(ta)))
    out = cells.groupBy(*dims).agg(F.sum("_x").alias("chi_square"), F.sum(seen).alias("_n"), F.count_if(seen > 0).alias("_k"))
    # two rows (reference, analysis): min(rows, columns) - 1 = 1 as soon as two categories occur
    v = F.when(F.col("_k") > 1, F.sqrt(F.try_divide(F.col("chi_square"), F.col("_n").cast("double"))))
    return out.select(*dims, "chi_square", F.coalesce(v, F.lit(0.0)).alias("cramers_v"))


def with_thresholds(report: DataFrame, thresholds: DataFrame, on: str, value: str) -> DataFrame:
    """Report rows with their method's threshold and whether it is exceeded; methods without threshold never alert."""
    return report.join(thresholds, on, "left").withColumn("alert", F.coalesce(F.col(value) > F.col("threshold"), F.lit(False)))


def univariate_drift(
    reference: DataFrame,
    analysis: DataFrame,
    seg: str,
    *,
    continuous: Sequence[str] = (),
    categorical: Sequence[str] = (),
    limits: Mapping[str, float] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Per (segment, feature): Jensen-Shannon distance of the analysis rows from the reference rows, and its verdict.

    Continuous columns are binned on the reference's quantiles, categorical columns by value. All segments and columns
    are handled in one job; nothing is collected per model or column.
    """
    limit = {"continuous": 0.2, "categorical": 0.2, **(limits or {})}
    both = reference.withColumn("_set", F.lit("reference")).unionByName(
        analysis.withColumn("_set", F.lit("analysis")), allowMissingColumns=True
    )
    parts = []
    if continuous:
        edges = bin_edges(reference, seg, [], list(continuous), exact=exact)
        numbers = histogram(both, ["_set"], seg, list(continuous), edges)
        parts.append(numbers.select("_set", seg, "feature", F.col("bin").cast("string").alias("bin"), "bin_count").withColumn("kind", F.lit("continuous")))
    if categorical:
        parts.append(category_shares(both, ["_set"], seg, list(categorical)).withColumn("kind", F.lit("categorical")))
    cells = parts[0]
    for extra in parts[1:]:
        cells = cells.unionByName(extra)
    dims = [seg, "feature", "kind"]
    both_sets = bin_probabilities(cells, ["_set"], dims)
    pair = both_sets.groupBy(*dims, "bin").agg(
        F.max(F.when(F.col("_set") == "reference", F.col("prob"))).alias("p"),
        F.max(F.when(F.col("_set") == "analysis", F.col("prob"))).alias("q"),
    )
    p, q = _floor(F.col("p")), _floor(F.col("q"))
    m = (p + q) / 2.0
    out = pair.groupBy(*dims).agg(
        F.sqrt(0.5 * F.sum(p * F.ln(p / m)) + 0.5 * F.sum(q * F.ln(q / m))).alias("js_distance")
    )
    bound = F.when(F.col("kind") == "continuous", limit["continuous"]).otherwise(limit["categorical"])
    return out.withColumns({"threshold": bound, "alert": F.col("js_distance") > bound})
