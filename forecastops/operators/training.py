"""One model per segment: linear fits, parameter search and model choice from grouped moments.

A linear model needs only means and covariances. Spark forms them for all segments in one aggregation with map-side combine,
so a segment with a large share of the rows costs no more than its scan; what reaches Python is one row per segment.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fewest rows of a segment, and of the part of them that a search is fitted on.
MIN_ROWS, MIN_SAMPLE = 50, 20


def _moments(features: Sequence[str], y: str) -> dict[str, Column]:
    x = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    t = F.col(y).cast("double")
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    return {
        "n": F.count(F.lit(1)),
        "my": F.avg(t),
        "vyy": F.var_pop(t),
        "mx": F.array(*[F.avg(c) for c in x]),
        "cxy": F.array(*[F.covar_pop(c, t) for c in x]),
        "cxx": F.array(*[F.covar_pop(x[i], x[j]) for i, j in pairs]),
    }


def moments(df: DataFrame, group: Sequence[str], features: Sequence[str], y: str) -> DataFrame:
    """Means and population covariances of features and target per group; a null feature counts as 0, rows without target
    are left out. Their buffers are centred and merge centred, so large offsets cost no digits."""
    return df.where(F.col(y).isNotNull()).groupBy(*group).agg(*[c.alias(n) for n, c in _moments(features, y).items()])


def _centred(row, prefix: str, keep: Sequence[int]) -> tuple[float, float, float, np.ndarray, np.ndarray, np.ndarray]:
    """Row count, mean and variance of the target, then means, covariances with it and covariances of some features."""
    mx, cxy, cxx = (np.asarray(row[prefix + k], dtype=float) for k in ("mx", "cxy", "cxx"))
    d = len(mx)
    full = np.zeros((d, d))
    full[np.triu_indices(d)] = cxx
    full = full + np.triu(full, 1).T
    return float(row[prefix + "n"]), float(row[prefix + "my"]), float(row[prefix + "vyy"]), mx[keep], cxy[keep], full[np.ix_(keep, keep)]


def _solve(n: float, cxy: np.ndarray, cxx: np.ndarray, ridge: float) -> np.ndarray:
    """Least-squares slopes with a penalty; collinear features share their weight."""
    scale = np.sqrt(np.maximum(np.diag(cxx), 1e-12))
    scaled = (cxx + ridge / n * np.eye(len(cxy))) / np.outer(scale, scale)
    return np.linalg.lstsq(scaled, cxy / scale, rcond=1e-10)[0] / scale


def _rmse(part: tuple, intercept: float, slopes: np.ndarray) -> float:
    _, my, vyy, mx, cxy, cxx = part
    spread = vyy - 2 * slopes @ cxy + slopes @ cxx @ slopes
    return math.sqrt(max(spread, 0.0) + (my - intercept - slopes @ mx) ** 2)


def grouped_fit(df: DataFrame, seg: str, features: Sequence[str], y: str, ridge: float = 0.0) -> DataFrame:
    """(seg, n_rows, intercept, coefficients, train_rmse): a linear model per segment.

    ``coefficients`` follow the order of ``features``.
    """
    keep = list(range(len(features)))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                part = n, my, _, mx, cxy, cxx = _centred(row, "", keep)
                slopes = _solve(n, cxy, cxx, ridge)
                intercept = my - slopes @ mx
                out.append((row[seg], int(n), float(intercept), [float(v) for v in slopes], _rmse(part, intercept, slopes)))
            yield pd.DataFrame(out, columns=[seg, "n_rows", "intercept", "coefficients", "train_rmse"])

    kind = df.schema[seg].dataType.simpleString()
    schema = f"`{seg}` {kind}, n_rows bigint, intercept double, coefficients array<double>, train_rmse double"
    return moments(df, [seg], features, y).mapInPandas(solve, schema)


def draw_trials(features: Sequence[str], n: int = 15, seed: int = 42) -> list[dict]:
    """Random search space: a log-uniform penalty and a random non-empty subset of the features per trial."""
    rng = random.Random(seed)
    return [
        {
            "trial": i,
            "ridge": 10 ** rng.uniform(-3, 4),
            "features": sorted(rng.sample(range(len(features)), rng.randint(1, len(features)))),
        }
        for i in range(n)
    ]


def trial_search(
    df: DataFrame,
    seg: str,
    features: Sequence[str],
    y: str,
    trials: Sequence[Mapping],
    *,
    is_test: str = "is_test",
    min_rows: int = MIN_ROWS,
    min_sample: int = MIN_SAMPLE,
) -> DataFrame:
    """Every trial of every segment, fitted on the training rows and judged on the test rows.

    The data is read once whatever the number of trials: both fit and validation error follow from the moments.
    Segments with too few rows are not searched; :func:`unsearched_segments` names them.
    """
    plain = [
        {"trial": t["trial"], "ridge": float(t["ridge"]), "features": list(t.get("features", range(len(features))))}
        for t in trials
    ]
    names = list(features)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                for t in plain:
                    n, my, _, mx, cxy, cxx = _centred(row, "fit_", t["features"])
                    val = _centred(row, "val_", t["features"])
                    slopes = _solve(n, cxy, cxx, t["ridge"])
                    params = json.dumps({"ridge": t["ridge"], "features": [names[i] for i in t["features"]]})
                    out.append((row[seg], t["trial"], params, int(n), int(val[0]), _rmse(val, my - slopes @ mx, slopes)))
            yield pd.DataFrame(out, columns=[seg, "trial", "params", "sample_size", "validation_size", "val_rmse"])

    sums = moments(df.where(F.col(is_test).isNotNull()), [seg, is_test], features, y)
    names_of = [c for c in sums.columns if c not in (seg, is_test)]
    part = lambda c, test: F.max(F.when(F.col(is_test) == test, F.col(c)))
    wide = sums.groupBy(seg).agg(
        *[part(c, False).alias(f"fit_{c}") for c in names_of], *[part(c, True).alias(f"val_{c}") for c in names_of]
    )
    enough = (F.col("fit_n") + F.col("val_n") >= min_rows) & (F.col("fit_n") >= min_sample) & (F.col("val_n") > 0)
    kind = df.schema[seg].dataType.simpleString()
    schema = f"`{seg}` {kind}, trial int, params string, sample_size bigint, validation_size bigint, val_rmse double"
    return wide.where(enough).mapInPandas(evaluate, schema)


def unsearched_segments(df: DataFrame, seg: str, y: str, *, is_test: str = "is_test", min_rows: int = MIN_ROWS, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """(seg, n_rows, sample_size, reason) of the segments that :func:`trial_search` leaves out."""
    used = F.col(y).isNotNull() & F.col(is_test).isNotNull()
    counts = df.groupBy(seg).agg(F.count_if(used).alias("n_rows"), F.count_if(used & ~F.col(is_test)).alias("sample_size"))
    reason = (
        F.when(F.col("n_rows") < min_rows, "rows")
        .when(F.col("sample_size") < min_sample, "sample")
        .when(F.col("sample_size") == F.col("n_rows"), "no validation rows")
    )
    return counts.withColumn("reason", reason).where("reason is not null")


def best_trial(trials: DataFrame, seg: str) -> DataFrame:
    """The trial with the smallest validation error per segment, the earlier one on a tie."""
    rest = [c for c in trials.columns if c != seg]
    best = F.min_by(F.struct(*rest), F.struct("val_rmse", "trial")).alias("b")
    return trials.groupBy(seg).agg(best).select(seg, "b.*")


def resolve_params(
    segments: DataFrame, seg: str, primary: DataFrame, fallback: DataFrame, defaults: Mapping, created: str = "created_at"
) -> DataFrame:
    """Parameters per segment: the best run of the primary store, else the latest row of the fallback table, else defaults."""
    first = primary.groupBy(seg).agg(F.min_by("params", "val_rmse").alias("_p1"))
    latest = fallback.groupBy(seg).agg(F.max_by("params", created).alias("_p2"))
    return (
        segments.select(seg)
        .distinct()
        .join(first, seg, "left")
        .join(latest, seg, "left")
        .select(
            seg,
            F.coalesce("_p1", "_p2", F.lit(json.dumps(dict(defaults)))).alias("params"),
            F.when(F.col("_p1").isNotNull(), "search").when(F.col("_p2").isNotNull(), "table").otherwise("default").alias("origin"),
        )
    )


def candidate_metrics(df: DataFrame, seg: str, y: str, candidates: Mapping[str, str | Column]) -> DataFrame:
    """(seg, candidate, n_rows, rmse, mae) of several forecasts of the same rows, all in one aggregation."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("candidate"), (F.col(c) if isinstance(c, str) else c).cast("double").alias("p"))
            for name, c in candidates.items()
        ]
    )
    err = F.col("c.p") - F.col(y).cast("double")
    return (
        df.select(seg, y, F.explode(cells).alias("c"))
        .groupBy(seg, F.col("c.candidate").alias("candidate"))
        .agg(F.count(err).alias("n_rows"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"))
    )


def best_candidate(metrics: DataFrame, seg: str) -> DataFrame:
    """The candidate with the smallest RMSE per segment, the first name on a tie."""
    rest = [c for c in metrics.columns if c != seg]
    return metrics.groupBy(seg).agg(F.min_by(F.struct(*rest), F.struct("rmse", "candidate")).alias("b")).select(seg, "b.*")


def representatives(df: DataFrame, seg: str, columns: Sequence[str]) -> DataFrame:
    """One sample row per segment (column-wise minimum, absent values as 0 or empty), as input example of a model."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    default = lambda c: F.lit("") if kinds[c] == "string" else F.lit(0).cast(kinds[c])
    return df.groupBy(seg).agg(*[F.coalesce(F.min(c), default(c)).alias(c) for c in columns])


def fit_trees(df: DataFrame, seg: str, segments: Sequence, features: Sequence[str], y: str, **params) -> dict:
    """Gradient-boosted trees per listed segment, each fitted by a distributed Spark ML job on that segment's rows."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    ready = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(
        df.na.fill(0, list(features)).where(F.col(y).isNotNull())
    )
    learner = GBTRegressor(featuresCol="_x", labelCol=y, predictionCol="prediction", **{"seed": 42, **params})
    return {s: learner.fit(ready.where(F.col(seg) == s).select("_x", y)) for s in segments}


def score_trees(df: DataFrame, seg: str, models: Mapping, features: Sequence[str], *, unknown: str = "raise") -> DataFrame:
    """Rows with their segment's tree model's prediction.

    Rows of a segment without model stop the job (``unknown="raise"``), or stay with a null prediction (``"null"``).
    The rows are read once per model: pass a frame stored by segment.
    """
    from pyspark.ml.feature import VectorAssembler

    ready = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(df.na.fill(0, list(features)))
    parts = [m.transform(ready.where(F.col(seg) == s)) for s, m in models.items()]
    other = ready.where(F.col(seg).isNull() | ~F.col(seg).isin(list(models)))
    missing = F.lit(None).cast("double")
    if unknown == "raise":
        missing = F.raise_error(F.concat(F.lit("no model for segment "), F.coalesce(F.col(seg).cast("string"), F.lit("null")))).cast("double")
    out = other.withColumn("prediction", missing)
    for p in parts:
        out = out.unionByName(p)
    return out.drop("_x")


def models_frame(spark: SparkSession, fitted: DataFrame, model: str, version: str) -> DataFrame:
    """Fitted segments as rows of a model table."""
    return fitted.withColumns({"model_name": F.lit(model), "model_version": F.lit(version)})
