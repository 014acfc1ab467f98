"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run of period q has at least four periods and six words, so each of its words occurs in it four times or more. A word that
occurs less often in a segment is in no run and splits it. Splitting goes on until every word of a segment occurs often
enough; only such segments are compared with themselves at each lag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has this many periods and this many words at least.
PERIODS, LEAST_WORDS = 4, 6
#: Up to this lag all words of a segment are compared; beyond, one word of each ``lag`` first.
_DENSE = 12


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of ``codes`` in which every word occurs ``PERIODS`` times or more; they hold all runs."""
    todo, done = [(0, len(codes))], []
    while todo:
        start, end = todo.pop()
        if end - start < LEAST_WORDS:
            continue
        _, place, counts = np.unique(codes[start:end], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[place] < PERIODS)
        if not len(rare):
            done.append((start, end))
            continue
        cuts = np.concatenate([[-1], rare, [end - start]])
        long = np.flatnonzero(np.diff(cuts) > LEAST_WORDS)
        todo.extend((int(start + cuts[i] + 1), int(start + cuts[i + 1])) for i in long)
    return done


def _equal_from(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of ``a`` and ``b``."""
    size, at, step = min(len(a), len(b)), 0, 64
    while at < size:
        other = a[at : min(at + step, size)] != b[at : min(at + step, size)]
        if other.any():
            return at + int(other.argmax())
        at, step = at + step, 2 * step
    return size


def _stretches(w: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int]]:
    """Maximal (start, end) of ``least`` or more places whose words equal those ``lag`` further on; ``least`` >= 3 lag."""
    if lag <= _DENSE:
        same = w[lag:] == w[:-lag]
        if np.count_nonzero(same) < least:
            return
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start >= least:
                yield int(start), int(end)
        return
    # a stretch of three lags holds three multiples of the lag in a row
    probes = w[:-lag:lag] == w[lag::lag]
    found = np.flatnonzero(probes[:-2] & probes[1:-1] & probes[2:]) * lag
    end = -1
    for at in found.tolist():
        if at < end:
            continue
        start = at - _equal_from(w[:at][::-1], w[lag : at + lag][::-1])
        end = at + _equal_from(w[at:], w[at + lag :])
        if end - start >= least:
            yield start, end


def runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs by start, then period; the period of a run is its smallest."""
    found: dict[tuple[int, int], int] = {}
    for first, last in segments(codes):
        part = codes[first:last]
        for lag in range(1, len(part) // PERIODS + 1):
            for start, end in _stretches(part, lag, max(LEAST_WORDS, PERIODS * lag) - lag):
                # the same stretch at a larger lag has a multiple of its period
                found.setdefault((first + start, end - start + lag), lag)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _found(text: str) -> tuple[list[dict], str]:
    """Runs of a text and its words without the repeats, joined by blanks."""
    words = text.encode().split()
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    all_runs = runs(codes)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in all_runs:
        step[start + period] += 1
        step[start + length] -= 1
    kept = np.cumsum(step)[:-1] == 0
    out = [{"start": s, "length": n, "period": q} for s, n, q in all_runs]
    return out, b" ".join(w for w, k in zip(words, kept.tolist()) if k).decode()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """Per row: id, runs (array of start, length, period, by start, then period) and collapsed (text without the repeats).

    Words are runs of anything but ASCII white space, numbered from 0. A run has a smallest period q, at least
    max(6, 4 q) words, and no neighbouring word extends it. ``collapsed`` drops each word that a run contains after its first
    q words. Null, empty and blank texts have no runs and an empty ``collapsed``; repeated rows are looked at each; an
    empty table gives no rows; other columns are left out. Rows stay in their partition, nothing is shuffled.
    """
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                found = [_found(t) for t in part["text"]]
                yield pd.DataFrame({"id": part["id"], "runs": [f[0] for f in found], "collapsed": [f[1] for f in found]})

    return rows.mapInPandas(look, schema).withColumnRenamed("id", id_col)


def longest(found: Column) -> Column:
    """The run of greatest length, of equal ones the first by start, then period; null without runs."""
    order = F.transform(found, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    least = F.array_min(order)
    return F.when(F.size(found) > 0, F.struct(least["start"].alias("start"), (-least["n"]).alias("length"), least["period"].alias("period")))


def written(found: Column) -> Column:
    """All runs as lines ``start,length,period``."""
    return F.concat_ws("", F.transform(found, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
