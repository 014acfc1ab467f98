"""Successive halving: many trials on few rows, the best of them on more, for all segments in the same pass.

Rungs read nested samples chosen by a hash of the row key. After a rung each segment keeps the best part of its trials; a
segment with one trial left is settled and its rows are not read again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecastops.functions.keys import stable_bucket
from forecastops.operators.training import _centred, _rmse, _solve, moments
from forecastops.session import small_side, store

#: Percentages of the rows that the rungs read.
RUNGS = (10, 30, 100)


def _judged(sums: DataFrame, seg: str, trials: Sequence[Mapping], features: Sequence[str]) -> DataFrame:
    """Fit and judge the trials listed in ``alive`` from the moments of fitted and held-out rows."""
    plain = {int(t["trial"]): (float(t["ridge"]), list(t.get("features", range(len(features))))) for t in trials}
    names = list(features)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                for trial in row["alive"]:
                    ridge, keep = plain[int(trial)]
                    n, my, _, mx, cxy, cxx = _centred(row, "fit_", keep)
                    val = _centred(row, "val_", keep)
                    slopes = _solve(n, cxy, cxx, ridge)
                    params = json.dumps({"ridge": ridge, "features": [names[i] for i in keep]})
                    out.append((row[seg], int(trial), params, int(n), int(val[0]), _rmse(val, my - slopes @ mx, slopes)))
            yield pd.DataFrame(out, columns=[seg, "trial", "params", "sample_size", "validation_size", "val_rmse"])

    kind = sums.schema[seg].dataType.simpleString()
    return sums.mapInPandas(evaluate, f"`{seg}` {kind}, trial int, params string, sample_size bigint, validation_size bigint, val_rmse double")


def halving_search(
    df: DataFrame,
    seg: str,
    features: Sequence[str],
    y: str,
    trials: Sequence[Mapping],
    ids: Sequence[str],
    *,
    is_test: str = "is_test",
    rungs: Sequence[int] = RUNGS,
    keep: int = 3,
    min_sample: int = 2,
) -> DataFrame:
    """(seg, rung, trial, params, sample_size, validation_size, val_rmse, place, kept) of every trial of every rung it reached.

    A rung fits its trials on the sampled training rows and judges them on the sampled test rows; one in ``keep`` of them,
    rounded up, goes on, by error and then trial number. Fitting needs means and covariances alone, so a rung reads its
    sample once for all segments and trials. A segment with fewer than ``min_sample`` fitted rows or without a test row in a
    sample skips that rung with all its trials. Rows without target or side are left out; a null segment is a segment.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(is_test).isNotNull()).select(F.col(seg).alias("_seg"), F.col(is_test).alias("_test"), F.col(y).alias("_y"), *[F.col(f).alias(f"_x{i}") for i, f in enumerate(features)], stable_bucket(100, *ids).alias("_bucket"))
    rows = store(rows)
    xs = [f"_x{i}" for i in range(len(features))]
    numbers = F.array(*[F.lit(int(t["trial"])) for t in trials])
    alive = store(rows.select("_seg").distinct().withColumn("alive", numbers))
    out = None
    for rung, percent in enumerate(rungs):
        open_segments = alive.where(F.size("alive") > 1) if rung else alive
        side = small_side(store(open_segments.withColumnRenamed("_seg", "_of")))
        sample = rows.where(F.col("_bucket") < percent).join(side.select("_of"), F.col("_seg").eqNullSafe(F.col("_of")), "left_semi")
        sums = moments(sample, ["_seg", "_test"], xs, "_y")
        part = lambda c, test: F.max(F.when(F.col("_test") == test, F.col(c)))
        own = [c for c in sums.columns if c not in ("_seg", "_test")]
        wide = sums.groupBy("_seg").agg(*[part(c, False).alias(f"fit_{c}") for c in own], *[part(c, True).alias(f"val_{c}") for c in own])
        wide = wide.where((F.col("fit_n") >= min_sample) & (F.col("val_n") > 0))
        judged = _judged(wide.join(side, F.col("_seg").eqNullSafe(F.col("_of"))).drop("_of"), "_seg", trials, features)
        by_error = Window.partitionBy("_seg").orderBy("val_rmse", "trial")
        stays = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("_seg")) / keep) if rung + 1 < len(rungs) else F.lit(1)
        ranked = judged.withColumn("place", F.row_number().over(by_error)).withColumn("kept", F.col("place") <= stays)
        ranked = store(ranked.withColumn("rung", F.lit(rung)))
        out = ranked if out is None else out.unionByName(ranked)
        left = ranked.where("kept").groupBy(F.col("_seg").alias("_of")).agg(F.sort_array(F.collect_list("trial")).alias("now"))
        alive = alive.join(left, F.col("_seg").eqNullSafe(F.col("_of")), "left")
        alive = store(alive.select("_seg", F.coalesce("now", "alive").alias("alive")))
    return out.select(F.col("_seg").alias(seg), "rung", "trial", "params", "sample_size", "validation_size", "val_rmse", "place", "kept")


def halving_best(search: DataFrame, seg: str) -> DataFrame:
    """The trial each segment ends with: the first of the last rung it reached."""
    rest = [c for c in search.columns if c not in (seg, "place", "kept")]
    best = F.max_by(F.struct(*rest), "rung").alias("b")
    return search.where("place = 1").groupBy(seg).agg(best).select(seg, "b.*")
