"""Exact positions, n-tiles and quantiles of groups of any size.

A window ordered over a whole group sends that group to one task. Here rows are range-partitioned on (group, order)
instead, so a large group spreads over many tasks, and positions are made global with per-partition counts, of which
there are at most (partitions + groups).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.session import cut, lookup, store

#: Up to this many distinct (group, value) pairs, running totals for exact quantiles come from one window per group. Beyond,
#: they come from range partitions; what is done with them is the same.
VALUE_PAIRS = 200_000
#: Groups of up to this many rows are sorted as a whole where a window over the group is the shorter way.
WINDOW_ROWS = 200_000


def _placed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted on (group, order), with partition ``_part`` and position ``_pos`` in it.

    The result is written to the shared folder: range bounds are sampled, so a second evaluation could place rows
    differently.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    at = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", at)
    return cut(placed).select(
        *df.columns, F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_pos")
    )


def _runs(placed: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Per (group, partition): rows before it in the group, own rows, group total, first position."""
    runs = placed.groupBy(*group, "_part").agg(F.sum(weight).alias("_n"), F.min("_pos").alias("_first"))
    ahead = Window.partitionBy(*group).orderBy("_part")
    return runs.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_total": F.sum("_n").over(Window.partitionBy(*group)),
        }
    )


def _on_run(left: DataFrame, runs: DataFrame, group: Sequence[str]) -> DataFrame:
    renamed = runs.withColumnsRenamed({g: f"_r_{g}" for g in group} | {"_part": "_r_part"})
    condition = left["_part"] == renamed["_r_part"]
    for g in group:
        condition = condition & left[g].eqNullSafe(renamed[f"_r_{g}"])
    return left.join(renamed, condition).drop("_r_part", *[f"_r_{g}" for g in group])


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], *, position: str = "rn", size: str | None = None
) -> DataFrame:
    """Add the 1-based position of each row in its group, and the group size if asked for.

    ``order`` must order a group's rows totally (end it with the ids). ``group`` may be empty.
    """
    placed = _placed(df, group, order)
    runs = lookup(_runs(placed, group, F.lit(1)))
    out = _on_run(placed, runs, group).withColumn(position, F.col("_pos") - F.col("_first") + F.col("_before") + 1)
    if size:
        out = out.withColumnRenamed("_total", size)
    return out.drop("_part", "_pos", "_n", "_first", "_before", "_total")


def tile_of(position: Column, size: Column, tiles: int) -> Column:
    """NTILE from a position and a group size: the first ``size % tiles`` tiles hold one row more."""
    base = F.floor(size / tiles)
    extra = size % tiles
    in_larger = extra * (base + 1)
    tile = F.when(position <= in_larger, F.floor((position - 1) / (base + 1)) + 1).otherwise(
        extra + F.floor((position - 1 - in_larger) / F.greatest(base, F.lit(1))) + 1
    )
    return tile.cast("int")


def add_ntile(df: DataFrame, group: Sequence[str], order: Sequence[str], tiles: int, name: str, *, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """NTILE(tiles) per group in the given total order: a value, then ids that break its ties.

    If no group has more than ``window_rows`` rows, a window over each group answers. Otherwise counts per (group, value) tell the tile of every value that lies in one tile; only rows whose value reaches into a
    second tile are ranked by their ids. Full rows are not sorted; they are written once, as they are read several times.
    """
    value, ids = order[0], list(order[1:])
    df = store(df)
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= window_rows:
        within = Window.partitionBy(*(group or [F.lit(0)])).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return df.withColumn(name, F.ntile(tiles).over(within))
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))
    placed = _placed(counts, group, [value])
    in_run = Window.partitionBy(*group, "_part").orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("_c").over(in_run)
    rows = _on_run(placed, lookup(_runs(placed, group, F.col("_c"))), group).withColumn("_upto", upto)
    before = F.col("_upto") - F.col("_c")
    rows = rows.withColumns({"_lo": tile_of(before + 1, F.col("_total"), tiles), "_hi": tile_of(F.col("_upto"), F.col("_total"), tiles), "_at": before})
    v = F.struct(F.col(value).alias("v"))
    whole = rows.where("_lo = _hi").groupBy(*group, "_lo").agg(F.min(v).alias("_v")).select(*group, F.col("_v.v").alias("v"), F.col("_lo").alias("tile"), F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("total"))
    split = rows.where("_lo < _hi").select(*group, F.col(value).alias("v"), F.lit(None).cast("int").alias("tile"), F.col("_at").cast("bigint").alias("at"), F.col("_total").cast("bigint").alias("total"))
    cell = F.struct("v", "tile", "at", "total")
    edges = whole.unionByName(split).groupBy(*group).agg(F.collect_list(F.when(F.col("at").isNull(), cell)).alias("_whole"), F.collect_list(F.when(F.col("at").isNotNull(), cell)).alias("_split"))
    side = lookup(edges.withColumnsRenamed({g: f"_g_{g}" for g in group}))
    if group:
        joined = df.join(side, [df[g].eqNullSafe(F.col(f"_g_{g}")) for g in group]).drop(*[f"_g_{g}" for g in group])
    else:
        joined = df.withColumn("_edges", side.select(F.struct("_whole", "_split")).scalar()).select(*df.columns, "_edges.*")
    own = F.col(value)
    tied = F.exists("_split", lambda c: c["v"].eqNullSafe(own))
    below = F.filter("_whole", lambda c: c["v"].isNull() | (c["v"] <= own))
    plain = joined.where(~tied).withColumn(name, F.array_max(F.transform(below, lambda c: c["tile"]))).drop("_whole", "_split")
    run = joined.where(tied).withColumn("_cell", F.get(F.filter("_split", lambda c: c["v"].eqNullSafe(own)), F.lit(0)))
    ranked = number_rows(run.drop("_whole", "_split"), [*group, value], ids, position="_rn")
    ranked = ranked.withColumn(name, tile_of(F.col("_cell.at") + F.col("_rn"), F.col("_cell.total"), tiles)).drop("_cell", "_rn")
    return plain.unionByName(ranked)


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    exact: bool = True,
    accuracy: int = 10_000,
    value_pairs: int = VALUE_PAIRS,
) -> DataFrame:
    """One row per group with ``qs``, the quantiles of ``value`` at ``probs``; nulls and NaN are left out.

    ``exact`` interpolates between the neighbouring order statistics. Otherwise a mergeable sketch answers in one pass.
    """
    present = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *group, F.col(value).cast("double").alias("_v")
    )
    asked = F.array(*[F.lit(float(p)) for p in probs])
    if not exact:
        return present.groupBy(*group).agg(F.percentile_approx("_v", asked, accuracy).alias("qs"))
    counts = cut(present.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c")))
    if counts.limit(value_pairs + 1).count() <= value_pairs:
        w = Window.partitionBy(*group)
        upto = F.sum("_c").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
        rows = counts.withColumns({"_upto": upto, "_total": F.sum("_c").over(w)})
        return _at_ranks(rows.withColumn("_want", F.array(*_wanted(probs))), group)
    return _ranged_quantiles(counts, group, probs)


def _wanted(probs: Sequence[float]) -> list[Column]:
    """The two ranks (from 0) that each quantile of ``_total`` values lies between."""
    out = []
    for k, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        out += [
            F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"), (at - F.floor(at)).alias("frac"))
            for side, rank in ((0, F.floor(at)), (1, F.ceil(at)))
        ]
    return out


def _ranged_quantiles(counts: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from (group, value, count) rows: only the partitions that hold a wanted rank are read row by row."""
    placed = _placed(counts, group, ["_v"])
    runs = _runs(placed, group, F.col("_c"))
    inside = lambda t: (t["rank"] >= F.col("_before")) & (t["rank"] < F.col("_before") + F.col("_n"))
    located = runs.withColumn("_want", F.filter(F.array(*_wanted(probs)), inside)).where(F.size("_want") > 0)
    rows = _on_run(placed, lookup(located.drop("_total", "_first")), group)
    w = Window.partitionBy(*group, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return _at_ranks(rows.withColumn("_upto", F.col("_before") + F.sum("_c").over(w)), group)


def _at_ranks(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Quantiles from value counts with their running total ``_upto`` and the ranks ``_want``, whichever way these were found."""
    held = F.filter("_want", lambda t: (t["rank"] < F.col("_upto")) & (t["rank"] >= F.col("_upto") - F.col("_c")))
    hits = rows.select(*group, "_v", F.explode(held).alias("t"))
    each = hits.groupBy(*group, F.col("t.k").alias("k")).agg(
        F.max(F.when(F.col("t.side") == 0, F.col("_v"))).alias("lo"),
        F.max(F.when(F.col("t.side") == 1, F.col("_v"))).alias("hi"),
        F.max("t.frac").alias("frac"),
    )
    point = F.struct("k", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("q"))
    return each.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(point)), lambda s: s["q"]).alias("qs"))
