"""Scoring: routing of each segment to its model, the prediction contract, canary split."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.contracts import PREDICTIONS, conform
from forecastops.functions.calendar import calmonth, week_to_date
from forecastops.functions.keys import entity_key, entity_map, record_id, stable_bucket
from forecastops.session import lookup


def _required(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")


def partitioned_score(
    df: DataFrame, models: DataFrame, seg: str | Sequence[str], features: Sequence[str], *, unknown: str = "raise", prediction: str = "prediction"
) -> DataFrame:
    """Prediction of each row by its segment's linear model, as a column expression over the joined coefficients.

    ``seg`` is one column or several that name a model together; nulls are values like any other.

    Rows of a segment without model stop the job (``unknown="raise"``), or stay with a null prediction (``"null"``).
    """
    parts = [seg] if isinstance(seg, str) else list(seg)
    _required(df, [*parts, *features])
    side = lookup(models.select(*[F.col(c).alias(f"_m_{c}") for c in parts], "intercept", "coefficients", F.lit(True).alias("_has")))
    joined = df.join(side, [df[c].eqNullSafe(F.col(f"_m_{c}")) for c in parts], "left")
    value = F.col("intercept")
    for i, f in enumerate(features):
        value = value + F.get("coefficients", F.lit(i)) * F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    if unknown == "raise":
        named = F.concat_ws(", ", *[F.coalesce(df[c].cast("string"), F.lit("null")) for c in parts])
        text = F.concat(F.lit("no model for segment "), named)
        value = F.when(F.col("_has").isNull(), F.raise_error(text).cast("double")).otherwise(value)
    return joined.withColumn(prediction, value).drop("_has", "intercept", "coefficients", *[f"_m_{c}" for c in parts])


def routed_score(
    df: DataFrame,
    seg: str,
    predictors: Mapping[str, Callable[[pd.DataFrame], pd.Series]],
    features: Sequence[str],
    keys: Sequence[str],
    prediction: str = "prediction",
) -> DataFrame:
    """Predictions of arbitrary Python models, one per segment, batch by batch where the rows are.

    No shuffle by segment is needed to route rows, so a large segment is scored by all tasks. A segment without model
    raises.
    """
    _required(df, [seg, *features, *keys])
    routes, cols = dict(predictors), list(features)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[[*keys, seg]].copy()
            out[prediction] = 0.0
            for name, rows in pdf.groupby(seg, dropna=False).groups.items():
                if name not in routes:
                    raise ValueError(f"no model for segment {name!r}; known: {sorted(map(str, routes))}")
                x = pdf.loc[rows, cols].fillna(0).astype(float)
                out.loc[rows, prediction] = pd.Series(routes[name](x), index=rows).astype(float)
            yield out

    wanted = df.select(*dict.fromkeys([*keys, seg, *features]))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [*keys, seg]) + f", `{prediction}` double"
    return wanted.mapInPandas(score, schema)


def prediction_records(
    scored: DataFrame,
    model: str,
    version: str | Column,
    seg: str,
    ids: Sequence[str],
    *,
    week: str = "week",
    target: str = "y",
    prediction: str = "prediction",
    unit: str,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Scored rows in the predictions contract: deterministic id, key bag, month."""
    v = F.lit(version) if isinstance(version, str) else version
    date = week_to_date(week)
    bag = {i: i for i in ids} | {
        "partition_col": F.lit(seg),
        "partition_value": F.col(seg),
        "target_col": F.lit(target),
        "week": F.col(week),
        "data_date": date,
    }
    rows = scored.select(
        record_id(F.lit(model), v, week, *ids, seg).alias("record_id"),
        F.lit(model).alias("model_name"),
        v.alias("model_version"),
        entity_map(bag).alias("entity_map"),
        F.col(week).cast("int").alias("week"),
        F.col(prediction).cast("double").alias("prediction"),
        F.lit(unit).alias("bkcc"),
        calmonth(date).alias("calmonth"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("ldts"),
    )
    return conform(rows, PREDICTIONS)


def prediction_view(predictions: DataFrame, ids: Mapping[str, str], seg: str) -> DataFrame:
    """Prediction rows with typed key columns read from the bag (``ids``: name -> type) and the segment."""
    return predictions.select(
        "model_name",
        "model_version",
        *[entity_key("entity_map", k, t).alias(k) for k, t in ids.items()],
        "week",
        entity_key("entity_map", "partition_value").alias(seg),
        "prediction",
    )


def scoring_batches(df: DataFrame, ids: Sequence[str], batches: int) -> DataFrame:
    """Add ``batch``: rows cut into batches by key hash, the same in every run, without sorting or paging."""
    return df.withColumn("batch", stable_bucket(batches, *ids))


def assign_groups(df: DataFrame, mapping: DataFrame, keys: Sequence[str], seg: str) -> DataFrame:
    """Rows with the segment their instance is mapped to; unmapped instances have none."""
    return df.join(mapping.select(*keys, seg), list(keys), "left")


def canary_split(df: DataFrame, ids: Sequence[str], percent: int) -> DataFrame:
    """Add ``route``: the given percentage of keys to ``candidate``, the rest to ``production``."""
    return df.withColumn("route", F.when(stable_bucket(100, *ids) < percent, "candidate").otherwise("production"))


def canary_score(
    df: DataFrame, ids: Sequence[str], percent: int, candidate: DataFrame, production: DataFrame, seg: str, features: Sequence[str]
) -> DataFrame:
    """Every row scored once, by the version its key is routed to, with that version's name.

    Both versions' models are one lookup keyed by (route, segment), so the rows are read once.
    """
    routed = canary_split(df, ids, percent)
    both = candidate.withColumn("route", F.lit("candidate")).unionByName(production.withColumn("route", F.lit("production")))
    names = both.groupBy("route").agg(F.max("model_version").alias("model_version"))
    return partitioned_score(routed, both, ["route", seg], features).join(lookup(names), "route")
