import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from forecastops.llm import periodic_runs as pr


def brute(w):
    """All runs, straight from their definition."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=18), st.integers(1, 9)), max_size=6))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(parts):
    w = [x for part, times in parts for x in part * times]
    assert pr.runs(np.array(w, dtype=np.int64)) == brute(w)


def test_long_periods_and_segments():
    rng = random.Random(1)
    period = [rng.randrange(50) for _ in range(40)]
    w = [rng.randrange(900, 999) for _ in range(30)] + period * 5 + [7] * 9 + [rng.randrange(60) for _ in range(200)] + period[:37] * 4
    assert pr.runs(np.array(w)) == brute(w)
    # a word that occurs three times in a segment splits it, and the pieces again
    assert pr.segments(np.array([1, 1, 1, 1, 1, 1, 2, 1, 2, 3, 3, 3, 3, 3, 3, 3])) == [(9, 16), (0, 6)]


def test_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \n", "a", "x " * 50_000, "a b\x1fb a b\x1fb a b\x1fb a b\x1fb", "é ü\té ü\né ü\x0bé ü é"]
    for _ in range(30):
        part = [rng.choice("abcdef") for _ in range(rng.randrange(1, 9))]
        texts.append(" ".join(rng.choices("abcdefgh", k=rng.randrange(12)) + part * rng.randrange(2, 8) + rng.choices("abc", k=20)))
    given_rows = [*enumerate(texts), (3, "a"), (None, "b b b b b b")]
    docs = spark.createDataFrame([(i, t, 5, [1], "s") for i, t in given_rows], "doc_id long, text string, id int, runs array<int>, collapsed string").repartition(3)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(docs).collect()), key=str)
    want = []
    for i, t in given_rows:
        w = [x.decode() for x in (t or "").encode().split()]
        want.append((i, runs := ([(0, 50_000, 1)] if len(w) == 50_000 else brute(w)), collapsed(w, runs) if len(w) < 50_000 else "x"))
    assert got == sorted(want, key=str)
    assert pr.periodic_runs(docs.limit(0)).collect() == []


def test_longest_and_lines(spark):
    docs = spark.createDataFrame([(1, "c c c c c c a a a a a a"), (2, "none")], "doc_id long, text string")
    found = pr.periodic_runs(docs)
    rows = {r.doc_id: r for r in found.select("doc_id", pr.longest(found.runs).alias("best"), pr.written(found.runs).alias("lines")).collect()}
    assert tuple(rows[1].best) == (0, 6, 1) and rows[1].lines == "0,6,1\n6,6,1\n"
    assert rows[2].best is None and hashlib.sha256(rows[2].lines.encode()).hexdigest().startswith("e3b0c442")
