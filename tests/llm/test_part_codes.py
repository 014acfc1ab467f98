import math
import random

import numpy as np
import pytest

from forecastops.llm import part_codes as pc


def brute(rows, entries=256):
    """Codes and errors of (id, vector) rows and the codebooks, one part after another."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 4
    out, books = [[i, "", 0] for i, _ in kept], []
    for pos in range(4):
        parts = [v[pos * size : (pos + 1) * size] for _, v in kept]
        book = parts[:entries]

        def near(p):
            return min((sum((a - b) ** 2 for a, b in zip(p, c)), e) for e, c in enumerate(book))

        for _ in range(4):
            mine = {}
            for p in parts:
                mine.setdefault(near(p)[1], []).append(p)
            book = [[sum(x) // len(mine[e]) for x in zip(*mine[e])] if e in mine else c for e, c in enumerate(book)]
        for row, p in zip(out, parts):
            error, e = near(p)
            row[1] += f"{e:02x}"
            row[2] += error
        books.append(book)
    return sorted(map(tuple, out), key=str), books


def rows_of(found):
    return sorted(((r.vec_id, bytes(r.code).hex(), r.error) for r in found.collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, id string, code int, error int"


def test_against_brute_force(spark):
    rng = random.Random(3)
    some = [[rng.choice([-1.5, -0.001, 0.0, 0.25, 0.3, 2.0]) for _ in range(12)] for _ in range(150)]
    given = [(i, some[rng.randrange(150)]) for i in range(420)]
    given += [(3, some[0]), (3, some[0]), (None, some[1]), (900, None), (901, [float("nan")] * 12), (902, [None] + [1.0] * 11), (903, [float("-inf")] * 12)]
    labels = [None if i % 5 == 0 else i % 3 for i in range(len(given))]
    table = spark.createDataFrame([(i, v, label, "x", 1, 2) for (i, v), label in zip(given, labels)], SCHEMA).repartition(5)
    # the numbers as stored, in four bytes
    exact = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in given]
    found, books = pc.compress(table)
    want, want_books = brute(exact)
    assert books.tolist() == want_books
    assert rows_of(found) == want
    sums = {}
    for r in found.collect():
        sums.setdefault(r.label, []).append((r.error, r.label_error))
    assert None in sums
    for pairs in sums.values():
        assert {total for _, total in pairs} == {sum(e for e, _ in pairs)}


def test_lengths_large_numbers_and_empty(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, []), (3, [1e30, -1e30, 5.0, 6.0, 7.0])]
    found, books = pc.compress(spark.createDataFrame([(i, v, 1, "x", 1, 2) for i, v in rows], SCHEMA))
    assert books.shape == (4, 3, 2) and books.max() == pc.limit(8)
    assert [r[2] for r in rows_of(found)] == [0, 0, 0]
    empty, books = pc.compress(spark.createDataFrame([(1, None, 1, "x", 1, 2)], SCHEMA))
    assert empty.collect() == [] and books.shape[1] == 0
    blank, _ = pc.compress(spark.createDataFrame([(1, [], None, "x", 1, 2)] * 2, SCHEMA))
    assert rows_of(blank) == [(1, "00000000", 0)] * 2


@pytest.mark.parametrize("leaves", [1, 3, 2048])
def test_walk_of_the_trie(monkeypatch, leaves):
    monkeypatch.setattr(pc, "LEAVES", leaves)
    rng = np.random.default_rng(5)
    parts = pc._sorted_parts(rng.integers(-3, 4, size=(300, 4)))[0]
    book = rng.integers(-3, 4, size=(20, 4))
    distances = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    index, error = pc.nearest(parts, book)
    assert index.tolist() == distances.argmin(axis=1).tolist() and error.tolist() == distances.min(axis=1).tolist()


def test_limit_keeps_errors_in_a_long():
    for width in (1, 4, 64, 100, 4096):
        assert width * (2 * pc.limit(width)) ** 2 <= 1 << 62
