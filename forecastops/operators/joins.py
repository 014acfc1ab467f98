"""Point-in-time and range joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.session import lookup, store


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of both sides with null equal to null; each key stands once in the result."""
    other = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    joined = left.join(other, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys], how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        # a row of one side has null in all keys of the other
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"_on_{k}")) for k in keys})
    return joined.drop(*[f"_on_{k}" for k in keys])


def _carry_forward(n_keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives each question of a sorted partition the last feature of its key before it, and says what the partition ends with.

    Rows are (keys, _side: 0 feature, 1 question; _s, _f). Questions of the partition's first key that meet no feature are
    open: the feature may lie in an earlier partition. The last row out holds the last key and its last feature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry, first = TaskContext.get().partitionId(), None, True

        def out(s: pa.Array, f: pa.Array, is_open: np.ndarray, last: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([s, f, pa.array(is_open), pa.array(np.full(len(s), part, dtype=np.int32)), last], ["_s", "_f", "_open", "_part", "_last"])

        last_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.schema.field(i) for i in range(n_keys)]
            last_type = pa.struct([pa.field(f"k{i}", f.type) for i, f in enumerate(keys)])
            rows = batch if carry is None else pa.concat_batches([carry, batch])
            n, at = rows.num_rows, np.arange(rows.num_rows)
            new = np.zeros(n, dtype=bool)
            for i in range(n_keys):
                column = rows.column(i)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            side = rows.column("_side").to_numpy()
            start = np.maximum.accumulate(np.where(new, at, 0))
            known = np.maximum.accumulate(np.where(side == 0, at, -1))
            has = known >= start
            asked = np.flatnonzero(side == 1)
            is_open = ~has & (start == 0) & first
            taken = pa.array(np.where(has, known, 0)[asked], mask=~has[asked])
            yield out(rows.column("_s").take(pa.array(asked)), rows.column("_f").take(taken), is_open[asked], pa.nulls(len(asked), last_type))
            first = first and not new.any()
            # the last key goes on in the next batch, with its last feature or as a mark that it has none
            carry = rows.slice(int(known[-1]), 1) if has[-1] else rows.slice(n - 1, 1)
            if not has[-1]:
                carry = carry.set_column(n_keys, carry.schema.field(n_keys), pa.array([2], type=pa.int32()))
        if carry is not None:
            last = pa.StructArray.from_arrays([carry.column(i) for i in range(n_keys)], fields=list(last_type))
            yield out(pa.nulls(1, carry.schema.field("_s").type), carry.column("_f"), np.array([False]), last)

    return run


def asof_join(spine: DataFrame, features: DataFrame, keys: Sequence[str], spine_ts: str, feature_ts: str, *, tie_break: Sequence[str] = ()) -> DataFrame:
    """Each spine row with the latest feature row of its entity at or before its time; nulls where there is none.

    Both sides are sorted once, by ranges of (entity, time), so an entity with a large share of the rows lies in many
    tasks. Each task carries the last feature forward over its rows; what a partition ends with is a border of one row, and
    rows at the start of a partition take their feature from the border before it.

    Of feature rows with equal entity and time the greatest by ``tie_break`` wins (all columns if none is given). A null
    entity or time meets nothing. The ranges are sampled, so both sides are read twice: pass stored frames where making
    them is expensive.
    """
    values = [c for c in features.columns if c not in keys and c != feature_ts]
    timed = lambda c: F.col(c).cast("timestamp").alias("_ts")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    order = [f"_k{i}" for i in range(len(keys))]
    whole = F.struct(*[F.col(f"`{c}`") for c in spine.columns])
    point = F.struct(F.col(feature_ts).cast("timestamp").alias("_ts"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(values)])
    complete = lambda ts: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, ts]])
    asked = spine.where(complete(spine_ts)).select(*named, timed(spine_ts), F.lit(1).alias("_side"), whole.alias("_s"))
    known = features.where(complete(feature_ts)).select(*named, timed(feature_ts), F.lit(0).alias("_side"), point.alias("_f"))
    both = known.unionByName(asked, allowMissingColumns=True)
    ties = [F.col("_f")[f"v{values.index(c)}"] for c in (tie_break or values)]
    by = [F.col(c) for c in [*order, "_ts", "_side"]]
    ranged = both.repartitionByRange(*by[:-1]).sortWithinPartitions(*by, *ties).select(*order, "_side", "_s", "_f")
    kinds = {f.name: f.dataType.simpleString() for f in ranged.schema}
    last = ",".join(f"k{i}:{kinds[c]}" for i, c in enumerate(order))
    schema = f"_s {kinds['_s']}, _f {kinds['_f']}, _open boolean, _part int, _last struct<{last}>"
    carried = store(ranged.mapInArrow(_carry_forward(len(keys)), schema))
    # one row per partition
    in_order = Window.partitionBy("_last").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    borders = carried.where("_last is not null").select("_part", "_last", F.last("_f", ignorenulls=True).over(in_order).alias("_b"))
    before = borders.select(F.lead("_part").over(Window.partitionBy(F.lit(0)).orderBy("_part")).alias("_p"), F.col("_last").alias("_l"), "_b")
    rows = carried.where("_last is null")
    own = F.struct(*[F.col("_s")[k].alias(f"k{i}") for i, k in enumerate(keys)])
    met = rows.join(lookup(before.where("_p is not null and _b is not null")), F.col("_open") & (F.col("_part") == F.col("_p")) & (own == F.col("_l")), "left")
    answer = F.coalesce("_f", "_b")
    kept = met.select(*[F.col("_s")[c].alias(c) for c in spine.columns], answer["_ts"].alias(feature_ts), *[answer[f"v{i}"].alias(c) for i, c in enumerate(values)])
    return kept.unionByName(spine.where(~complete(spine_ts)), allowMissingColumns=True)


def for_each_of(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Each row once per value of a small list; the list travels as one array, so there is no join.

    The result has rows x values rows by definition.
    """
    listed: Column = values.agg(F.sort_array(F.collect_set(column))).scalar()
    return df.withColumn(column, F.explode(listed))
