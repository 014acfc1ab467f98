"""Vector compression by codebooks of vector parts, assigned along a trie of the distinct parts.

Vectors become integers and are cut into equal parts. The distinct parts of each position, with their counts, are shuffled
once into lexicographic order. A sorted stretch of them is a trie: a depth-first walk adds, per dimension, the squared
difference to every codebook entry, and parts that share their first dimensions share the sums so far. At the leaves the
least sum gives the entry, and parts weighted by their counts give the next codebook. A codebook is of fixed size, so it
alone goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.session import small_side, store

#: Parts of a vector, entries of a codebook, rounds of assigning and averaging, and the factor that makes integers.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Leaves of a subtree that is walked level by level; larger ones are walked child by child.
LEAVES = 2048
#: Vectors of one block.
_ROWS = 4096


def finite(vector: Column) -> Column:
    """Vectors that are kept: no null, no null, NaN or infinite component."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(good, F.lit(False))


def limit(width: int) -> int:
    """Greatest integer component; with it the error of ``width`` components fits a long."""
    return 1 << (30 - ((max(width, 1) - 1).bit_length() + 1) // 2)


def _integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of ``width`` integers; shorter vectors are filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    most = limit(width)
    whole = np.clip(np.floor(values * scale), -most, most).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return whole.reshape(len(lengths), width)
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(whole)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    return out


def _sorted_parts(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the place of each row among them, and their counts."""
    if not part.shape[1]:
        return part[:1], np.zeros(len(part), dtype=np.int64), np.array([len(part)])
    order = np.lexsort(part.T[::-1])
    ranked = part[order]
    new = np.ones(len(part), dtype=bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(part), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place, np.diff(np.append(np.flatnonzero(new), len(part)))


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the lexicographically sorted ``parts``: nearest entry (ties to the lower) and its squared distance."""
    index, error = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
    todo = [(0, len(parts), 0, np.zeros((1, len(book)), dtype=np.int64))]
    while todo:
        start, end, depth, sums = todo.pop()
        rows = parts[start:end]
        if len(rows) > LEAVES and depth < parts.shape[1]:
            cuts = [0, *(np.flatnonzero(np.diff(rows[:, depth])) + 1).tolist(), len(rows)]
            below, at = [], 0
            for a, b in zip(cuts, cuts[1:]):
                # small neighbours stay together, a large child goes on its own
                if b - at > LEAVES and a > at:
                    below.append((start + at, start + a, depth, sums))
                    at = a
                if b - a > LEAVES:
                    below.append((start + a, start + b, depth + 1, sums + (rows[a, depth] - book[:, depth]) ** 2))
                    at = b
            if at < len(rows):
                below.append((start + at, end, depth, sums))
            todo.extend(reversed(below))
            continue
        node, new = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=bool)
        new[:1] = True
        for k in range(depth, parts.shape[1]):
            new[1:] |= rows[1:, k] != rows[:-1, k]
            first = np.flatnonzero(new)
            step = rows[first, k][:, None] - book[:, k]
            sums = sums[node[first]] + step * step
            node = np.cumsum(new) - 1
        best = sums.argmin(axis=1)
        index[start:end] = best[node]
        error[start:end] = sums[np.arange(len(sums)), best][node]
    return index, error


def _distinct_parts(vectors: DataFrame, width: int, scale: int, parts: int) -> DataFrame:
    """(pos, part, n): distinct parts of each position in lexicographic order over the partitions. ``vectors`` has vector."""
    size = width // parts

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = _integers(batch.column("vector").slice(at, _ROWS), width, scale)
                for pos in range(parts):
                    found, _, counts = _sorted_parts(rows[:, pos * size : (pos + 1) * size])
                    lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * size, found.astype(np.int32).ravel())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), pos, dtype=np.int32)), lists, pa.array(counts.astype(np.int64))], ["pos", "part", "n"])

    found = vectors.mapInArrow(cut_up, "pos int, part array<int>, n long")
    ranged = found.repartitionByRange("pos", "part").groupBy("pos", "part").agg(F.sum("n").alias("n"))
    return store(ranged.sortWithinPartitions("pos", "part"))


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), size)


def _averaged(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each entry the floor of the mean of the parts nearest to it; unused ones stay."""
    parts, entries, size = books.shape
    shared = distinct.sparkSession.sparkContext.broadcast(books)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        sums = np.zeros((parts, entries, size + 1), dtype=np.int64)
        for batch in batches:
            positions = batch.column("pos").to_numpy()
            rows, counts = _matrix(batch.column("part"), size), batch.column("n").to_numpy()
            for pos in np.unique(positions).tolist():
                mine = positions == pos
                index, _ = nearest(rows[mine], book[pos])
                np.add.at(sums[pos], index, np.column_stack([counts[mine], rows[mine] * counts[mine][:, None]]))
        pos, entry, _ = used = np.nonzero(sums[:, :, :1])
        for k in range(size + 1):
            columns = [used[0].astype(np.int32), used[1].astype(np.int32), np.full(len(pos), k, dtype=np.int32), sums[pos, entry, k]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pos", "entry", "k", "total"])

    totals = distinct.mapInArrow(walk, "pos int, entry int, k int, total long")
    # a row per number of the codebooks comes back, whatever the number of vectors
    rows = totals.groupBy("pos", "entry", "k").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {(r.pos, r.entry, r.k): int(r.total) for r in rows}
    out = books.copy()
    for pos, entry, k in found:
        if k:
            out[pos, entry, k - 1] = found[pos, entry, k] // found[pos, entry, 0]
    return out


def learn(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (part, entry, dimension) of ``vectors`` (id, vector), started from the ``entries`` smallest ids."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    rows = _integers(first.column("vector").combine_chunks(), width, scale)
    books = np.ascontiguousarray(rows.reshape(len(rows), parts, width // parts).transpose(1, 0, 2))
    distinct = _distinct_parts(vectors, width, scale, parts)
    for _ in range(rounds):
        books = _averaged(distinct, books)
    return books


def assign(vectors: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``vectors`` (vector and other columns) with code (binary, a byte per part) and error in place of vector."""
    parts, _, size = books.shape
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    others = [f for f in vectors.schema if f.name != "vector"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                block = batch.slice(at, _ROWS)
                rows = _integers(block.column("vector"), parts * size, scale)
                codes, errors = np.zeros((len(rows), parts), dtype=np.uint8), np.zeros(len(rows), dtype=np.int64)
                for pos in range(parts):
                    found, place, _ = _sorted_parts(rows[:, pos * size : (pos + 1) * size])
                    index, error = nearest(found, book[pos])
                    codes[:, pos] = index[place]
                    errors += error[place]
                columns = [block.column(f.name) for f in others]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([c.tobytes() for c in codes], type=pa.binary()), pa.array(errors)], [*(f.name for f in others), "code", "error"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return vectors.mapInArrow(encode, f"{schema}, code binary, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): per kept vector its id, label, code (a byte per part), error and label_error.

    Vectors that are null or hold a null, NaN or infinite component are dropped. Components become floor(1024 x), bounded by
    :func:`limit` (2^27 at 64 dimensions); vectors shorter than the longest, rounded up to whole parts, are filled up with
    zeros. The codebooks start from the 256 smallest ids (null last, ties by vector), all of them if there are fewer.
    Repeated rows count each; null labels are one label; an empty table gives no rows and codebooks without entries; other
    columns are left out. ``label_error`` is at most the greatest long.
    """
    kept = vectors.filter(finite(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = learn(kept.select("id", "vector"), width)
    coded = store(assign(kept, books))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    labels = store(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")))
    rows = coded.join(small_side(labels), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return rows.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), books
