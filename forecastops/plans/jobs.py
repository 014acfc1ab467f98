"""End-to-end monitoring jobs over landing datasets: score, baselines, data drift, prediction drift, performance.

Every job finds the (week, version) pairs without results, computes all of them in one plan per breakdown column, and upserts by record id,
so that running it again changes nothing. Datasets lie under one root and are partitioned by calendar month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops import contracts as ct
from forecastops.functions.calendar import calmonth, week_to_date
from forecastops.functions import metrics as mt
from forecastops.functions.keys import entity_map, record_id
from forecastops.operators import alerts as al
from forecastops.operators import drift as dr
from forecastops.operators import histograms as hi
from forecastops.operators import performance as pf
from forecastops.operators import scoring as sc
from forecastops.operators.joins import for_each_of
from forecastops.session import cut, lookup
from forecastops.sources import landing as la
from forecastops.sources.tables import read_or_empty

# Names of the metrics in the landing tables.
PSI, JS = "population_stability_index", "jensen-shannon"
KEY, PARTITION = ["record_id", "calmonth"], ["calmonth"]
TABLES = {
    "predictions": ct.PREDICTIONS,
    "histograms_baseline": ct.HISTOGRAMS,
    "histograms": ct.HISTOGRAMS,
    "drift": ct.DRIFT,
    "prediction_histograms_baseline": ct.HISTOGRAMS,
    "prediction_histograms": ct.HISTOGRAMS,
    "prediction_drift": ct.DRIFT,
    "performance_baseline": ct.PERFORMANCE_BASELINE,
    "performance": ct.PERFORMANCE,
}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/{table}", TABLES[table])


def _land(spark: SparkSession, root: str, table: str, rows: DataFrame) -> None:
    la.upsert_path(spark, f"{root}/{table}", ct.conform(rows, TABLES[table]), KEY, PARTITION)


def _records(
    df: DataFrame, model: str, metric: str | Column, agg_col: str | Column, value: str | Column, extra: Sequence[str] = (), **columns: Column
) -> DataFrame:
    """Landing rows of metric cells; ``extra`` are further key columns (feature name, bin)."""
    metric = F.lit(metric) if isinstance(metric, str) else metric
    agg_col = F.lit(agg_col) if isinstance(agg_col, str) else agg_col
    value = F.lit(value) if isinstance(value, str) else value
    date = week_to_date("week")
    bag = {"week": F.col("week"), "data_date": date} | ({"feature_name": F.col("feature")} if "feature" in extra else {})
    return df.select(
        record_id(F.lit(model), "model_version", "week", agg_col, value, *extra, metric).alias("record_id"),
        F.lit(model).alias("model_name"),
        "model_version",
        entity_map(bag).alias("entity_map"),
        F.col("week").cast("int").alias("week"),
        agg_col.alias("aggregated_col"),
        value.cast("string").alias("aggregated_value"),
        metric.alias("metric_col"),
        calmonth(date).alias("calmonth"),
        F.current_timestamp().alias("ldts"),
        *[c.alias(n) for n, c in columns.items()],
    )


def _metric_map(**fields: Column) -> Column:
    return F.struct(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ct.METRIC_MAP]
    )


# --- scoring ------------------------------------------------------------------------------------------------------------


def score(
    spark: SparkSession, root: str, features: DataFrame, models: DataFrame, model: str, seg: str, columns: Sequence[str], ids: Sequence[str], *, unit: str
) -> None:
    """Predictions of every version for the weeks it has none for.

    ``models`` holds a row per (model_version, segment) with intercept and coefficients.
    """
    weeks = features.select("week").distinct()
    wanted = for_each_of(weeks, models, "model_version")
    landed = read(spark, root, "predictions").where(F.col("model_name") == model).select("week", "model_version")
    todo = lookup(la.missing_slices(wanted, landed, ["week", "model_version"]))
    if todo.isEmpty():
        return
    rows = _of_weeks(features, todo).join(todo, "week")
    scored = sc.partitioned_score(rows, models, ["model_version", seg], columns)
    _land(spark, root, "predictions", sc.prediction_records(scored, model, F.col("model_version"), seg, ids, unit=unit))


def _of_weeks(rows: DataFrame, todo: DataFrame) -> DataFrame:
    """Rows of the wanted weeks; the weeks are few and prune a dataset that is partitioned by them."""
    return rows.where(la.among(todo.select("week")))


# --- drift --------------------------------------------------------------------------------------------------------------


def _share_rows(shares: DataFrame, model: str, seg: str) -> DataFrame:
    bins = _metric_map(bin_count=F.col("bin_count"), bin_prop=F.col("bin_prop"))
    return _records(shares, model, PSI, seg, F.col(seg), metric_map=bins)


def _bin_rows(hist: DataFrame, model: str, seg: str) -> DataFrame:
    bins = _metric_map(bin_number=F.col("bin"), bin_low=F.col("bin_low"), bin_high=F.col("bin_high"), bin_count=F.col("bin_count"))
    return _records(hist, model, JS, seg, F.col(seg), ["feature", "bin"], metric_map=bins)


def _stored(table: DataFrame, model: str, metric: str, seg: str) -> DataFrame:
    """Landed histogram cells as typed columns."""
    bag, cell = F.col("entity_map"), F.col("metric_map")
    return table.where((F.col("model_name") == model) & (F.col("metric_col") == metric) & (F.col("aggregated_col") == seg)).select(
        "week",
        "model_version",
        F.col("aggregated_value").alias(seg),
        bag["feature_name"].alias("feature"),
        cell["bin_number"].alias("bin"),
        cell["bin_low"].alias("bin_low"),
        cell["bin_count"].alias("bin_count"),
        cell["bin_prop"].alias("bin_prop"),
    )


def drift_baseline(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    model: str,
    version: str,
    segs: Sequence[str],
    low: Sequence[str],
    high: Sequence[str],
    *,
    predictions: bool = False,
    exact: bool = False,
) -> None:
    """Segment shares and histograms of the baseline weeks of a version, on bins made from the same rows.

    With ``predictions`` the histograms of the prediction column go to the prediction tables instead. What a breakdown column
    already has of the version stays; further columns are added by a later call.
    """
    table = "prediction_histograms_baseline" if predictions else "histograms_baseline"
    known = read(spark, root, table).where((F.col("model_name") == model) & (F.col("model_version") == version))
    done = {(r.aggregated_col, r.metric_col) for r in known.where(F.col("aggregated_col").isin(list(segs))).select("aggregated_col", "metric_col").distinct().collect()}
    tagged = rows.withColumn("model_version", F.lit(version))
    parts = []
    for seg in segs:
        if not predictions and (seg, PSI) not in done:
            parts.append(_share_rows(hi.proportions(tagged, ["week", "model_version"], seg), model, seg))
        if (seg, JS) not in done:
            edges = hi.bin_edges(rows, seg, low, high, exact=exact)
            parts.append(_bin_rows(hi.histogram(tagged, ["week", "model_version"], seg, [*low, *high], edges), model, seg))
    if not parts:
        return
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    _land(spark, root, table, out)


def _drift_rows(
    df: DataFrame, model: str, metric: str, seg: str, value: str | Column, number: str, limits: tuple[float, float], unit: str, extra: Sequence[str] = ()
) -> DataFrame:
    return _records(
        df, model, metric, seg, value, extra,
        metric_value=F.col(number), warning_threshold=F.lit(limits[0]), critical_threshold=F.lit(limits[1]),
        alert_level=F.col("alert_level"), bkcc=F.lit(unit),
    )


def _without_value(out: DataFrame, todo: DataFrame) -> DataFrame:
    """The wanted pairs that gave no row, with a null number: all their segments are unknown to the baseline.

    They are landed as well, so that the next run does not take them up again.
    """
    rest = la.missing_slices(todo, out, ["week", "model_version"])
    return rest.select("week", "model_version", *[F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema if f.name not in ("week", "model_version")])


def _version_histogram(todo: DataFrame, rows: DataFrame, stored: DataFrame, seg: str, columns: Sequence[str]) -> DataFrame:
    """Histograms of the wanted (week, version) pairs, each version on its own baseline's bins."""
    both = ["model_version", seg]
    edges = cut(hi.bins_to_edges(stored, both))
    hist = hi.histogram(rows, ["week"], both, columns, edges)
    # bins of a version only at the weeks asked of that version
    return hist.join(todo, ["week", "model_version"], "left_semi")


def _land_distance(spark: SparkSession, root: str, table: str, hist: DataFrame, stored: DataFrame, todo: DataFrame, model: str, seg: str, unit: str) -> None:
    out = cut(dr.js_distance(hist, stored, ["week", "model_version"], [seg, "feature"], keys=["model_version"]))
    rows = _drift_rows(out, model, JS, seg, F.col(seg), "js_distance", dr.JS_LIMITS, unit, ["feature"])
    none = _drift_rows(_without_value(out, todo), model, JS, seg, pf.FULL_MODEL, "js_distance", dr.JS_LIMITS, unit)
    _land(spark, root, table, rows.unionByName(none))


def data_drift(
    spark: SparkSession, root: str, features: DataFrame, model: str, segs: Sequence[str], columns: Sequence[str], *, unit: str, min_week: int | None = None
) -> None:
    """Segment-share PSI and feature Jensen-Shannon distance of every new (week, version), with alerts.

    A pair whose segments are all unknown to the baseline lands with a null value.
    """
    predictions = read(spark, root, "predictions").where(F.col("model_name") == model)
    time = ["week", "model_version"]
    base = read(spark, root, "histograms_baseline")

    def missing(seg: str, metric: str) -> DataFrame:
        # read anew each time: landing a metric replaces partition files
        landed = read(spark, root, "drift").where(F.col("model_name") == model)
        return lookup(la.new_combos(predictions, landed, seg, metric, min_week))

    for seg in segs:
        todo = missing(seg, PSI)
        if not todo.isEmpty():
            shares = cut(hi.proportions(_of_weeks(features, todo).join(todo, "week"), time, seg))
            _land(spark, root, "histograms", _share_rows(shares, model, seg))
            out = cut(dr.psi(shares, _stored(base, model, PSI, seg), seg, time, keys=["model_version"]))
            rows = out.unionByName(_without_value(out, todo))
            _land(spark, root, "drift", _drift_rows(rows, model, PSI, seg, pf.FULL_MODEL, "psi", dr.PSI_LIMITS, unit))
        todo = missing(seg, JS)
        if not todo.isEmpty():
            stored = cut(_stored(base, model, JS, seg))
            hist = cut(_version_histogram(todo, _of_weeks(features, todo).join(todo, "week"), stored, seg, columns))
            _land(spark, root, "histograms", _bin_rows(hist, model, seg))
            _land_distance(spark, root, "drift", hist, stored, todo, model, seg, unit)


def prediction_drift(
    spark: SparkSession, root: str, model: str, segs: Sequence[str], view: DataFrame, *, unit: str, min_week: int | None = None
) -> None:
    """Jensen-Shannon distance of the predictions of every new (week, version).

    ``view`` holds week, model_version, prediction and the breakdown columns of the landed predictions.
    """
    predictions = read(spark, root, "predictions").where(F.col("model_name") == model)
    for seg in segs:
        landed = read(spark, root, "prediction_drift").where(F.col("model_name") == model)
        todo = lookup(la.new_combos(predictions, landed, seg, JS, min_week))
        if todo.isEmpty():
            continue
        stored = cut(_stored(read(spark, root, "prediction_histograms_baseline"), model, JS, seg))
        rows = _of_weeks(view, todo).join(todo, ["week", "model_version"], "left_semi")
        hist = cut(_version_histogram(todo, rows, stored, seg, ["prediction"]))
        _land(spark, root, "prediction_histograms", _bin_rows(hist, model, seg))
        _land_distance(spark, root, "prediction_drift", hist, stored, todo, model, seg, unit)


# --- performance ----------------------------------------------------------------------------------------------------------


def _metric_rows(df: DataFrame, model: str, unit: str, **columns: Column) -> DataFrame:
    return _records(
        df, model, F.col("metric_col"), F.col("aggregated_col"), F.col("aggregated_value"),
        metric_value=F.col("metric_value"), bkcc=F.lit(unit), **columns,
    )


def performance_baseline(
    spark: SparkSession, root: str, view: DataFrame, actuals: DataFrame, model: str, segs: Sequence[str], y: str, keys: Sequence[str], *, unit: str
) -> None:
    """Error metrics of the baseline weeks; forecasts without actual are left out."""
    paired = pf.pair_actuals(view, actuals, keys, y, "inner")
    _land(spark, root, "performance_baseline", _metric_rows(pf.metric_rollup(paired, segs, y, "prediction"), model, unit))


def performance(
    spark: SparkSession, root: str, view: DataFrame, actuals: DataFrame, model: str, segs: Sequence[str], y: str, keys: Sequence[str], *, unit: str, min_week: int | None = None
) -> None:
    """Error metrics of every new (week, version) that has actuals, their change from the baseline, alerts.

    A pair is new as long as any breakdown column lacks any metric, so a column added later is made up for. In production a
    forecast without actual counts as a sale of 0.
    """
    predictions = read(spark, root, "predictions").where(F.col("model_name") == model)
    landed = read(spark, root, "performance").where(F.col("model_name") == model)
    cells = F.explode(F.array(*[F.struct(F.lit(s).alias("aggregated_col"), F.lit(n).alias("metric_col")) for s in segs for n in mt.monitored()]))
    pairs = predictions if min_week is None else predictions.where((F.col("calmonth") >= calmonth(week_to_date(F.lit(min_week)))) & (F.col("week") >= min_week))
    wanted = pairs.select("week", "model_version").distinct().select("week", "model_version", cells.alias("c")).select("week", "model_version", "c.*")
    missing = la.missing_slices(wanted, landed, ["week", "model_version", "aggregated_col", "metric_col"])
    todo = lookup(missing.select("week", "model_version").distinct().join(actuals.select("week").distinct(), "week", "left_semi"))
    if todo.isEmpty():
        return
    rows = _of_weeks(view, todo).join(todo, ["week", "model_version"], "left_semi")
    metrics = pf.metric_rollup(pf.pair_actuals(rows, actuals, keys, y, "left"), segs, y, "prediction")
    base = pf.metric_baseline(read(spark, root, "performance_baseline").where(F.col("model_name") == model))
    out = al.relative_alert(metrics, base)
    names = ("metric_drift", "warning_threshold", "critical_threshold", "alert_level")
    _land(spark, root, "performance", _metric_rows(out, model, unit, **{n: F.col(n) for n in names}))


def summary(spark: SparkSession, root: str, tables: Mapping[str, object] = TABLES) -> DataFrame:
    """Row count of every landing dataset."""
    return la.landing_summary({t: read(spark, root, t) for t in tables})
