"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1, linear between knots. The integral of a schedule is the
source's weight in the mix; its running integral, scaled to the source's target, is the cumulative demand for the source's
words. Documents of a source stand in a fixed pseudo-random order and so own consecutive stretches of the source's
word stream; inverting the demand at the middle of a stretch gives the document's training position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecastops.llm.text import word_count
from forecastops.session import small_side, store

Knots = Sequence[tuple[float, float]]

#: Weights 3, 1, 2 as schedules: falling, level and rising.
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 4.5), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)),
)
#: A stretch of one source's order that a single window sums; grows with the square root of the source.
STRETCH_ROWS = 256


def _segments(knots: Knots) -> list[tuple[float, float, float, float]]:
    """(start, weight there, slope, integral up to there) of each linear piece."""
    if len(knots) < 2 or any(a[0] >= b[0] for a, b in zip(knots, knots[1:])) or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs two or more knots with rising times and weights of 0 or more")
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((float(t0), float(w0), (w1 - w0) / (t1 - t0), done))
        done += (w0 + w1) / 2 * (t1 - t0)
    return out


def _integral(knots: Knots) -> float:
    return sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))


def source_targets(sizes: DataFrame, schedules: Sequence[Knots] = SCHEDULES, budget: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """One row per source: rank, source_size, rows, weight, target, shape (index of its schedule).

    Sources stand by code point, null last, and take ``schedules`` in turn. ``budget`` times all sizes are shared by weight;
    no target exceeds ``repeat`` times its source, the excess goes to the others by weight. ``sizes`` has source and size.
    The unpartitioned windows here order one row per source, never documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weights = F.array(*[F.lit(_integral(k)) for k in schedules])
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("shape", (F.pmod(F.col("rank") - 1, F.lit(len(schedules)))).cast("int"))
    ranked = ranked.withColumn("weight", F.element_at(weights, F.col("shape") + 1))
    ranked = ranked.withColumn("cap", repeat * F.col("source_size"))
    # fill the caps in the order in which a rising level meets them: the first source whose cap lies above the level
    # that the sources from it on would share tells the level
    by_cap = Window.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", F.when(F.col("weight") > 0, level))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    # without rounding the levels of the sources that fit fall no further than the first one's
    ranked = ranked.withColumn("level", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(everything))
    target = F.when(F.col("weight") > 0, F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))).otherwise(F.lit(0.0))
    return ranked.select("source", "rank", "source_size", "rows", "shape", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", schedules: Sequence[Knots] = SCHEDULES, budget: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """Per document: id, source, size, source_size, target (its source's), passes, taken, positions.

    ``passes`` counts how often the mix takes the document, at most ``repeat`` rounded down; ``taken`` is size times passes;
    ``positions`` are its training positions in 0..1, one per pass. Whole documents are taken, so a source's taken words
    differ from its target by at most half a document. A null text has size 0; rows that repeat an id stand for themselves;
    a null source is a source; an empty table gives no rows. Only ids, sources and sizes are shuffled: a source's order is
    cut into stretches by a hash of the id, each stretch is summed by a task and stretch totals are added up, so no source,
    however large, meets in one task.
    """
    sizes = store(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")))
    sources = small_side(store(source_targets(sizes, schedules, budget, repeat)))
    key = F.coalesce(F.md5(F.col("id").cast("string").cast("binary")), F.lit("0" * 32))
    placed = sizes.join(sources.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    stretches = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.greatest(F.lit(float(STRETCH_ROWS)), F.sqrt("rows"))))
    placed = placed.withColumn("key", key).withColumn("stretch", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2**32 * stretches))
    placed = placed.select("id", "source", "size", "source_size", "target", "rank", "shape", "key", "stretch")
    in_source = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("rank", "stretch").agg(F.sum("size").alias("words"))
    offsets = offsets.select("rank", "stretch", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("offset"))
    in_stretch = Window.partitionBy("rank", "stretch").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("running", F.sum("size").over(in_stretch)).join(offsets, ["rank", "stretch"])
    middle = F.col("offset") + F.col("running") - F.col("size") / 2
    middles = F.filter(F.transform(F.sequence(F.lit(0), F.lit(int(repeat) - 1)), lambda k: middle + k * F.col("source_size")), lambda m: m < F.col("target"))
    placed = placed.withColumn("middles", middles if repeat >= 1 else F.array().cast("array<double>"))
    passes = F.size("middles")
    return placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        passes.cast("long").alias("passes"), (passes * F.col("size")).cast("long").alias("taken"),
        F.transform("middles", lambda m: _position(m / F.col("target"), schedules)).alias("positions"),
    )


def _position(share, schedules: Sequence[Knots]):
    """Time at which a source has met ``share`` of its demand: the inverse of its schedule's normalised integral."""
    pieces = F.array(*[F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, ("start", "weight", "slope", "done"))]) for s in _segments(k)]) for k in schedules])
    wanted = share * F.element_at(F.array(*[F.lit(_integral(k)) for k in schedules]), F.col("shape") + 1)
    piece = F.element_at(F.filter(F.element_at(pieces, F.col("shape") + 1), lambda s: s["done"] <= wanted), -1)
    rest = wanted - piece["done"]
    root = piece["weight"] + F.sqrt(piece["weight"] * piece["weight"] + 2 * piece["slope"] * rest)
    return piece["start"] + F.when(root > 0, 2 * rest / root).otherwise(0.0)


def training_order(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document and pass with its position, range-partitioned and sorted by position, then id."""
    rows = plan.select("*", F.posexplode("positions").alias("pass", "position")).drop("positions")
    return rows.repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)
