import random

import numpy as np
import pytest

from forecastops.llm import repeated_strings as rs


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, kept) of each row, from the earliest place of every string."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for at in range(len(data) - length + 1 if i is not None else 0):
            key, place = data[at : at + length], (i, at)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1 if i is not None else 0):
            if first[data[at : at + length]] < (i, at):
                gone[at : at + length] = [True] * length
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((i, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def texts(rng, letters, n):
    passage = "".join(rng.choices(letters, k=90))
    out = []
    for _ in range(n):
        t = "".join(rng.choices(letters, k=rng.randrange(0, 120)))
        if rng.random() < 0.6:
            a = rng.randrange(60)
            t += passage[a : a + rng.randrange(5, 90)] + "".join(rng.choices(letters, k=rng.randrange(9)))
        if out and rng.random() < 0.5:
            other = rng.choice(out)
            at = rng.randrange(len(other) + 1)
            t = other[:at] + rng.choice(letters) + other[at:] + t[: rng.randrange(20)]
        out.append(t)
    return out


SCHEMA = "doc_id long, text string, doc int, v string, at array<int>"


@pytest.mark.parametrize("letters, length, size, steps", [("ab", 20, 6, (4, 1)), ("abcdefghijklmné", 20, 6, (4, 1)), ("abcdefgh", 100, 32, (9, 1)), ("abcd", 12, 12, (1,))])
def test_against_brute_force(spark, monkeypatch, letters, length, size, steps):
    monkeypatch.setattr(rs, "STEPS", steps)
    rng = random.Random(length + len(letters))
    given = list(enumerate(texts(rng, letters, 60)))
    given += [(100, None), (101, ""), (102, "a" * 400), (103, "ab" * 150), (3, given[3][1]), (4, given[5][1]), (None, given[7][1]), (None, "a" * 300), (-5, given[9][1])]
    rng.shuffle(given)
    docs = spark.createDataFrame([(i, t, 1, "x", [2]) for i, t in given], SCHEMA).repartition(4)
    assert rows_of(rs.without_repeats(docs, length=length, size=size)) == brute(given, length)


def test_empty_and_without_repeats(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rs.without_repeats(empty).collect() == []
    one = spark.createDataFrame([(7, "x" * 99, 1, "x", [2])], SCHEMA)
    assert rows_of(rs.without_repeats(one)) == [(7, 99, 0, 0, b"x" * 99)]


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(8)
    data = np.frombuffer("".join(rng.choices("abc", k=3000)).encode(), dtype=np.uint8)
    bounds = np.array([0, 0, 50, 1200, 1200, 2999, 3000])

    def starts(found):
        """name of each start's sampled tuple; a run cut in two keeps its names"""
        out = {}
        for row, packed, name, _ in found:
            for r, lo, size, x, k in zip(row, *rs._unpacked(packed), name):
                out.update({(int(r), int(lo) + j): (int(x) - j, int(k)) for j in range(int(size) + 1)})
        return out

    whole = starts(rs.first_runs(data, bounds, 100, 32))
    assert len(whole) == 1051 + 1700
    monkeypatch.setattr(rs, "_STARTS", 256)
    assert starts(rs.first_runs(data, bounds, 100, 32)) == whole
