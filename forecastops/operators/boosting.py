"""Histogram gradient boosting of one model per segment, all segments grown in the same passes over the rows.

A tree is grown level by level. Each level is one aggregation over (segment, node, feature, bin) with map-side combine, so
the number of scans is rounds x depth whatever the number of segments, and a segment with a large share of the rows is no
group of its own anywhere. The best split of each node is chosen from these sums; the model is one row per segment, and
predictions are an expression over its columns.

Gradients are whole numbers of ``UNIT``. Their sums are exact, so the trees do not depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.operators.ranking import quantiles
from forecastops.session import small_side, store

UNIT = 1e-6
SPLIT = "struct<feature:int,bin:int,left:double,right:double>"
TREE = f"map<int,{SPLIT}>"


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = 32, exact: bool = False) -> list[list[float]]:
    """Distinct inner quantiles of each feature: at most ``bins - 1`` numbers a feature come to the driver."""
    probs = [i / bins for i in range(1, bins)]
    out = []
    for f in features:
        rows = quantiles(df, [], f, probs, exact=exact).collect()
        out.append(sorted({float(q) for q in rows[0].qs or []}) if rows else [])
    return out


def _bin(value: Column, edges: Column) -> Column:
    """Number of edges below the value; 0 for null, so that nulls go left at every split."""
    return F.coalesce(F.size(F.filter(edges, lambda e: e < value.cast("double"))), F.lit(0))


def _bins(features: Sequence[str], edges: Column) -> Column:
    return F.array(*[_bin(F.col(f"`{f}`"), F.get(edges, F.lit(i))) for i, f in enumerate(features)])


def _descend(tree: Column, x: Column, depth: int) -> Column:
    """(node, value) that a row with bins ``x`` reaches; a child of node n is 2n or 2n + 1."""

    def step(at: Column, _: Column) -> Column:
        split = F.try_element_at(tree, at["node"])
        left = F.get(x, split["feature"]) <= split["bin"]
        below = F.struct((2 * at["node"] + F.when(left, 0).otherwise(1)).cast("int").alias("node"), F.when(left, split["left"]).otherwise(split["right"]).alias("value"))
        return F.when(split.isNull(), at).otherwise(below)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.struct(F.lit(1).alias("node"), F.lit(0.0).alias("value")), step)


def _predicted(base: Column, trees: Column, x: Column, depth: int) -> Column:
    return F.aggregate(trees, base, lambda total, tree: total + _descend(tree, x, depth)["value"])


def _best_splits(sums: DataFrame, rate: float, penalty: float, min_rows: int) -> DataFrame:
    """(seg, node, split) from (seg, node, feature, bin, g, n): the split of greatest gain, of equal ones the first."""
    upto = Window.partitionBy("seg", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("seg", "node", "feature")
    gl, nl, g, n = F.col("gl").cast("double"), F.col("nl"), F.col("gt").cast("double"), F.col("nt")
    part = lambda s, k: s * s / (k + F.lit(penalty))
    leaf = lambda s, k: F.lit(rate) * (s * F.lit(UNIT) / (k + F.lit(penalty)))
    cells = sums.withColumns({"gl": F.sum("g").over(upto), "nl": F.sum("n").over(upto), "gt": F.sum("g").over(whole), "nt": F.sum("n").over(whole)})
    cells = cells.where((nl >= min_rows) & (n - nl >= min_rows) & (n > nl))
    cells = cells.withColumn("gain", part(gl, nl) + part(g - gl, n - nl) - part(g, n)).where("gain > 0")
    split = F.struct("feature", "bin", leaf(gl, nl).alias("left"), leaf(g - gl, n - nl).alias("right"))
    return cells.groupBy("seg", "node").agg(F.max_by(split, F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("split"))


def fit_boosted(
    df: DataFrame,
    seg: str,
    features: Sequence[str],
    y: str,
    edges: Sequence[Sequence[float]],
    *,
    rounds: int = 20,
    depth: int = 3,
    rate: float = 0.1,
    penalty: float = 1.0,
    min_rows: int = 1,
    keep_every: int = 10,
) -> DataFrame:
    """(seg, n_rows, base, trees): squared-error boosting per segment, on features cut at ``edges``.

    A split sends bins up to its own left, nulls with them; NaN counts as greater than every edge. Rows without target are
    left out; a null segment is a segment; an empty table gives no rows. The rows are written once, and again every
    ``keep_every`` rounds with what the trees so far leave unexplained.
    """
    cuts = F.array(*[F.array(*[F.lit(float(e)) for e in part]).cast("array<double>") for part in edges])
    target = F.col(y).cast("double").alias("rest")
    rows = store(df.where(F.col(y).isNotNull()).select(F.col(seg).alias("seg"), _bins(features, cuts).alias("x"), target))
    total = F.sum(F.round(F.col("rest") / F.lit(UNIT)).cast("long")).cast("double")
    base = store(rows.groupBy("seg").agg(F.count(F.lit(1)).alias("n_rows"), (total / F.count(F.lit(1)) * F.lit(UNIT)).alias("base")))
    model = base.select("seg", F.col("base").alias("start"), F.array().cast(f"array<{TREE}>").alias("trees"))
    done: list[DataFrame] = []
    for turn in range(rounds):
        tree = model.withColumn("tree", F.create_map().cast(TREE))
        for level in range(depth):
            side = small_side(store(tree).withColumnRenamed("seg", "of"))
            joined = rows.join(side, F.col("seg").eqNullSafe(F.col("of")))
            left_over = F.round((F.col("rest") - _predicted(F.col("start"), F.col("trees"), F.col("x"), depth)) / F.lit(UNIT)).cast("long")
            node = _descend(F.col("tree"), F.col("x"), level)["node"] if level else F.lit(1)
            placed = joined.select("seg", "x", left_over.alias("g"), node.alias("node")).where(F.col("node") >= 2**level)
            cells = placed.select("seg", "node", "g", F.posexplode("x").alias("feature", "bin"))
            sums = cells.groupBy("seg", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
            grown = _best_splits(sums, rate, penalty, min_rows).groupBy("seg").agg(F.map_from_entries(F.collect_list(F.struct("node", "split"))).cast(TREE).alias("more"))
            grown = grown.withColumnRenamed("seg", "of")
            added = F.map_concat("tree", F.coalesce("more", F.create_map().cast(TREE)))
            tree = tree.join(small_side(store(grown)), F.col("seg").eqNullSafe(F.col("of")), "left").select("seg", "start", "trees", added.alias("tree"))
        model = store(tree.select("seg", "start", F.array_append("trees", F.col("tree")).alias("trees")))
        if (turn + 1) % keep_every == 0 and turn + 1 < rounds:
            done.append(model.select("seg", "trees"))
            side = small_side(model.withColumnRenamed("seg", "of"))
            left = F.col("rest") - _predicted(F.col("start"), F.col("trees"), F.col("x"), depth)
            rows = store(rows.join(side, F.col("seg").eqNullSafe(F.col("of"))).select("seg", "x", left.alias("rest")))
            model = model.select("seg", F.lit(0.0).alias("start"), F.array().cast(f"array<{TREE}>").alias("trees"))
    out = base
    for i, part in enumerate([*done, model.select("seg", "trees")]):
        out = out.join(part.select(F.col("seg").alias(f"_s{i}"), F.col("trees").alias(f"_t{i}")), F.col("seg").eqNullSafe(F.col(f"_s{i}"))).drop(f"_s{i}")
    parts = [F.col(f"_t{i}") for i in range(len(done) + 1)]
    fitted = out.select("seg", "n_rows", "base", F.concat(*parts).alias("trees"), cuts.alias("edges"), F.lit(depth).alias("depth"))
    return fitted.withColumnRenamed("seg", seg)


def predict_boosted(df: DataFrame, seg: str, features: Sequence[str], model: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``df`` with the prediction of its segment's trees; rows of a segment without model keep a null prediction."""
    depth = model.agg(F.max("depth")).first()[0] or 1
    side = small_side(store(model.select(F.col(seg).alias("_of"), "base", "trees", "edges")).withColumnsRenamed({"base": "_base", "trees": "_trees", "edges": "_edges"}))
    joined = df.join(side, df[seg].eqNullSafe(F.col("_of")), "left")
    value = _predicted(F.col("_base"), F.col("_trees"), _bins(features, F.col("_edges")), depth)
    return joined.withColumn(prediction, value).drop("_of", "_base", "_trees", "_edges")


def splits(model: DataFrame, seg: str, features: Sequence[str]) -> DataFrame:
    """(seg, round, node, feature, threshold, left, right): the trees as rows, rounds from 0."""
    trees = model.select(seg, "edges", F.posexplode("trees").alias("round", "tree"))
    rows = trees.select(seg, "edges", "round", F.explode("tree").alias("node", "split"))
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("split.feature")).alias("feature")
    threshold = F.get(F.get("edges", F.col("split.feature")), F.col("split.bin")).alias("threshold")
    return rows.select(seg, "round", "node", name, threshold, "split.left", "split.right")
