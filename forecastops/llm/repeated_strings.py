"""Removal of byte strings that occur earlier in the corpus, by names of sampled suffixes.

A string of 100 bytes is one suffix's prefix, and suffixes with equal prefixes are found from a sample of them. Of every 100
bytes the sample holds one place, the least hashed 32-byte tuple among the 69 that lie inside, so equal strings are sampled
at the same offset. The starts that share a place form a run. The steps are those of suffix sorting by a sample:

1. Name the sampled tuples. Runs under a name that occurs once hold nothing repeated and are settled.
2. Runs whose strings are equal as a whole are merged into the earliest; all strings of the others occur earlier.
3. What is left under a name with different runs is cut into shorter runs, aligned by their offset from the sampled place,
   named by the bytes all their strings share, and settled the same way, down to runs of a single start.

The sample is chosen by content. A difference cover of positions would hold two thirds of all suffixes instead of one in 35
(see README). Names are hashes, two of 64 bits for a string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.llm.text import utf8
from forecastops.session import small_side, store

#: Bytes of a repeated string, bytes of a sampled tuple, and starts of the shorter runs of each further step.
LENGTH, TUPLE = 100, 32
STEPS = (9, 1)
#: Starts that are looked at together; bounds the memory of a worker, also within one long text.
_STARTS = 1 << 20
_BITS = 7
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64((1 << 32) - 1)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M1
    h = (h ^ (h >> np.uint64(29))) * _M2
    return h ^ (h >> np.uint64(32))


class _Hash:
    """Hashes of the substrings of a byte array from running sums; one of two independent functions."""

    _powers: dict[tuple[int, int], np.ndarray] = {}

    def __init__(self, data: np.ndarray, which: int):
        factor = _MULTIPLIERS[which]
        letters = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * which)) * np.uint64(_MULTIPLIERS[1 - which]))
        self.back = self._power(pow(factor, -1, 1 << 64), len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters[data] * self._power(factor, len(data)), out=self.sums[1:])

    @classmethod
    def _power(cls, factor: int, size: int) -> np.ndarray:
        """1, factor, factor^2, ...; at least ``size`` are kept for the next call."""
        known = cls._powers.get((factor, 0))
        if known is None or len(known) < size:
            known = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, factor, dtype=np.uint64))])
            cls._powers[factor, 0] = known
        return known[:size]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def every(self, size: int) -> np.ndarray:
        """Hashes of all substrings of ``size``."""
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """Least value of each ``window`` neighbours."""
    width = 1
    while 2 * width <= window:
        values, width = np.minimum(values[:-width], values[width:]), 2 * width
    return values if width == window else np.minimum(values[: len(values) - (window - width)], values[window - width :])


def _packed(lo: np.ndarray, size: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A run in one number: first start, starts after it, and distance from the first start to the sampled place."""
    return (lo << 2 * _BITS) | (size << _BITS) | x


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << _BITS) - 1
    return at >> 2 * _BITS, (at >> _BITS) & mask, at & mask


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and where each value starts and ends."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def first_runs(data: np.ndarray, bounds: np.ndarray, length: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, packed run, name, hash of the run) of all texts in ``data``, block by block."""
    starts_in = np.ones(len(data), dtype=bool)
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        starts_in[max(a, z - length + 1) : z] = False
    for at in range(0, len(data) - length + 1, _STARTS):
        part = data[at : at + _STARTS + length - 1]
        valid = starts_in[at : at + _STARTS][: len(part) - length + 1]
        tuples = _Hash(part, 0).every(size)
        place = (_least((tuples & ~_LOW) | np.arange(len(tuples), dtype=np.uint64), length - size + 1) & _LOW).astype(np.int64)
        new, last = valid.copy(), valid.copy()
        differ = place[1:] != place[:-1]
        new[1:] &= differ | ~valid[:-1]
        last[:-1] &= differ | ~valid[1:]
        lo, hi = np.flatnonzero(new), np.flatnonzero(last)
        row = np.searchsorted(bounds, at + lo, side="right") - 1
        shape = _packed(np.zeros_like(lo), hi - lo, place[lo] - lo)
        whole = _mixed(_Hash(part, 1).of(lo, hi + length) ^ shape.astype(np.uint64))
        yield row, _packed(at + lo - bounds[row], hi - lo, place[lo] - lo), tuples[place[lo]], whole


def shorter_runs(data: np.ndarray, bounds: np.ndarray, row: np.ndarray, packed: np.ndarray, length: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """As :func:`first_runs`, of the given runs (by row) cut at multiples of ``width`` from the sampled place."""
    lo, size, x = _unpacked(packed)
    lo = lo + bounds[row]
    low_block, blocks = (x - size) // width, x // width - (x - size) // width + 1
    of = np.repeat(np.arange(len(lo)), blocks)
    block = low_block[of] + np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    place = (lo + x)[of]
    far, near = np.minimum(block * width + width - 1, x[of]), np.maximum(block * width, (x - size)[of])
    for at in range(0, len(data), _STARTS):
        part = data[at : at + _STARTS + 2 * length]
        mine = np.flatnonzero((place - far >= at) & (place - far < at + _STARTS))
        if not len(mine):
            continue
        first, last, shared = (place - far)[mine] - at, (place - near)[mine] - at, (place - block * width)[mine] - at
        name = _mixed(_Hash(part, 0).of(shared, shared + length - width + 1) ^ block[mine].astype(np.uint64))
        shape = _packed(np.zeros_like(first), last - first, far[mine])
        whole = _mixed(_Hash(part, 1).of(first, last + length) ^ shape.astype(np.uint64))
        rows = row[of[mine]]
        yield rows, _packed(first + at - bounds[rows], last - first, far[mine]), name, whole


def _batch(batch: pa.RecordBatch, found: Iterator[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Runs of a batch as rows. Those equal to an earlier run of the batch are marked, so that no group of copies is shuffled
    whole."""
    blocks = list(found) or [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))]
    row, packed, name, whole = (np.concatenate(c) for c in zip(*blocks))
    doc = batch.column("doc").to_numpy()[row]
    order = np.lexsort((packed, doc, whole, name))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (np.diff(name[order]) != 0) | (np.diff(whole[order]) != 0)
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    copy = np.zeros(len(row), dtype=bool)
    copy[order] = (doc[order] != doc[first]) | (packed[order] != packed[first])
    columns = [pa.array(doc), batch.column("v").take(pa.array(row)), pa.array(packed), pa.array(name.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(copy)]
    return pa.RecordBatch.from_arrays(columns, ["doc", "v", "at", "name", "whole", "copy"])


_RUN = "doc long, v long, at long, name long, whole long, copy boolean"


def _repeated(names: DataFrame) -> DataFrame:
    """Names that occur more than once, of (name, n)."""
    return small_side(store(names.groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name")), max_rows=4_000_000)


def _sampled(docs: DataFrame, length: int, size: int) -> DataFrame:
    """Runs of documents (doc, v, text) whose sampled tuple occurs more than once."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, name, _ in first_runs(*_bytes_of(batch.column("text")), length, size):
                found, counts = np.unique(name, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["name", "n"])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(batch, first_runs(*_bytes_of(batch.column("text")), length, size))

    repeated = _repeated(docs.select("text").mapInArrow(named, "name long, n long"))
    return store(docs.mapInArrow(cut_up, _RUN).join(repeated, "name", "left_semi"))


def _shortened(docs: DataFrame, runs: DataFrame, length: int, width: int) -> DataFrame:
    """``runs`` cut into shorter ones whose name occurs more than once."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ats")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            packed = lists.flatten().to_numpy(zero_copy_only=False)
            yield _batch(batch, shorter_runs(*_bytes_of(batch.column("text")), row, packed, length, width))

    lists = store(runs.groupBy(F.col("doc").alias("of"), F.col("v").alias("ov")).agg(F.collect_list("at").alias("ats")))
    given = docs.join(small_side(lists, max_rows=4_000_000), (F.col("doc") == F.col("of")) & (F.col("v") == F.col("ov")))
    cut_runs = store(given.select("doc", "v", "text", "ats").mapInArrow(cut_up, _RUN))
    return cut_runs.join(_repeated(cut_runs.select("name", F.lit(1).cast("long").alias("n"))), "name", "left_semi")


def _settled(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, rest) of the stored ``runs``: those equal as a whole to an earlier run, and others whose name has different
    runs. A group holds one run of each batch at most, as the batches have marked the other copies."""
    first = F.min(F.struct("doc", "at")).over(Window.partitionBy("name", "whole"))
    placed = store(runs.filter("not copy").drop("copy").withColumn("first", first).withColumn("later", F.struct("doc", "at") > F.col("first")).drop("first"))
    several = placed.filter("not later").groupBy("name").agg((F.min("whole") < F.max("whole")).alias("several")).filter("several").select("name")
    copies = runs.filter("copy").select("doc", "v", "at").unionByName(placed.filter("later").select("doc", "v", "at"))
    rest = placed.filter("not later").join(small_side(store(several), max_rows=4_000_000), "name", "left_semi")
    return copies, rest.select("doc", "v", "at")


def _covered(copies: DataFrame, length: int) -> DataFrame:
    """(of, ov, spans): starts and ends of the stretches that the strings of a document's copies cover, in order."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ats in batch.column("ats"):
                lo, size, _ = _unpacked(np.sort(np.asarray(ats.values)))
                end = np.maximum.accumulate(lo + size + length)
                new = np.flatnonzero(lo[1:] > end[:-1])
                out.append(np.column_stack([lo[np.append(0, new + 1)], end[np.append(new, len(end) - 1)]]).ravel())
            yield pa.RecordBatch.from_arrays([batch.column("of"), batch.column("ov"), pa.array(out, type=pa.list_(pa.int64()))], ["of", "ov", "spans"])

    lists = copies.groupBy(F.col("doc").alias("of"), F.col("v").alias("ov")).agg(F.collect_list("at").alias("ats"))
    return store(lists.mapInArrow(merge, "of long, ov long, spans array<bigint>"))


def _cleaned(docs: DataFrame) -> DataFrame:
    """Rows (id, text, spans) as (id, n_bytes, n_removed, n_spans, kept)."""
    kind = docs.schema["id"].dataType.simpleString()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch.column("text"))
            removed, kept = [], []
            spans = batch.column("spans")
            for i, found in enumerate(spans):
                text, at = data[bounds[i] : bounds[i + 1]], np.asarray(found.values).reshape(-1, 2)
                removed.append(int((at[:, 1] - at[:, 0]).sum()))
                edges = [0, *at.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:z].tobytes() for a, z in zip(edges[::2], edges[1::2])))
            n_spans = np.diff(spans.offsets.to_numpy()) // 2
            numbers = [pa.array(np.asarray(v, dtype=np.int64)) for v in (np.diff(bounds), removed, n_spans)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *numbers, pa.array(kept, type=pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return docs.mapInArrow(clean, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", length: int = LENGTH, size: int = TUPLE) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (removed stretches) and kept (bytes of the text without them).

    A byte is removed if a string of ``length`` bytes covers it that also starts earlier: under a smaller id, or before in
    the same document. Strings are judged on the given texts, and none crosses documents. Ids are integers. Rows that repeat
    an id are one document for the order: a string at the same place of both is not earlier in either. A row without an id
    has no place in the order and stays whole, and so do null and shorter texts. An empty table gives no rows; other columns
    are left out. ``length - size`` is below 128.
    """
    data = utf8(F.col(text_col) if isinstance(text_col, str) else text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("long").alias("doc"), data.alias("text"))
    rows = rows.withColumn("v", F.crc32("text"))
    sized = rows.filter(F.col("doc").isNotNull() & (F.length("text") >= length)).select("doc", "v", "text")
    runs = _sampled(sized, length, size)
    copies, rest = _settled(runs)
    for width in STEPS:
        runs = store(_shortened(sized, rest, length, width))
        more, rest = _settled(runs)
        copies = copies.unionByName(more)
    covers = small_side(_covered(copies, length), max_rows=4_000_000)
    given = rows.join(covers, (F.col("doc") == F.col("of")) & (F.col("v") == F.col("ov")), "left")
    none = F.array().cast("array<bigint>")
    return _cleaned(given.select("id", "text", F.coalesce("spans", none).alias("spans"))).withColumnRenamed("id", id_col)
