"""Features as known in a batch about a day, against a dictionary per batch."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from forecastops.operators import bitemporal as bt

SCHEMA = "who string, day date, a int, b string"
D0 = dt.date(2024, 1, 1)


def batches(seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(4):
        rows = {}
        for _ in range(40):
            rows[rng.choice(["x", "y", "z", None, "w"]), D0 + dt.timedelta(days=rng.randrange(6))] = (rng.choice([1, 2, None]), rng.choice(["p", None]))
        out.append(rows)
    return out


def test_every_batch_can_be_read_back(spark, folder):
    path, known, states = f"{folder}/h", {}, []
    for n, rows in enumerate(batches(), 1):
        frame = spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)
        for _ in range(2):  # the second run changes nothing
            bt.apply_batch(spark, path, frame, n, ["who"], "day", buckets=8)
        known = {**known, **rows}
        states.append(dict(known))
    history = spark.read.parquet(path)
    for n, state in enumerate(states, 1):
        rows = bt.known_in(history, n).collect()
        assert len(rows) == len(state) and {((r.who, r.day), (r.a, r.b)) for r in rows} == set(state.items())
        for d in range(6):
            at = D0 + dt.timedelta(days=d)
            want = {}
            for (who, day), v in sorted(state.items(), key=lambda x: x[0][1]):
                if day <= at:
                    want[who] = (day, *v)
            got = {r.who: (r.day, r.a, r.b) for r in bt.as_of(history, n, F.lit(at), ["who"], "day").collect()}
            assert got == want
    # a row that stopped holding was replaced in the same batch
    assert history.where("known_to <= known_from").count() == 0
    added = bt.changes(history, 1, 3)
    assert {r.change for r in added.collect()} == {"added", "closed"}


def test_only_touched_buckets_are_rewritten(spark, folder):
    path = f"{folder}/h"
    rows = spark.createDataFrame([(f"e{i}", D0, i, "s") for i in range(50)], SCHEMA)
    every = bt.apply_batch(spark, path, rows, 1, ["who"], "day", buckets=8)
    files = lambda: {b: {e.name for e in os.scandir(f"{path}/bucket={b}") if e.name.endswith("parquet")} for b in every}
    before = files()
    touched = bt.apply_batch(spark, path, spark.createDataFrame([("e7", D0, 70, "s")], SCHEMA), 2, ["who"], "day", buckets=8)
    after = files()
    assert len(touched) == 1 and all((before[b] == after[b]) == (b not in touched) for b in every)
    assert spark.read.parquet(path).count() == 51


def test_corrected_batches_order_and_empty_batches(spark, folder):
    path = f"{folder}/h"
    one = lambda v: spark.createDataFrame([("e", D0, v, "s"), ("e", D0, v - 1, "s")], SCHEMA)
    bt.apply_batch(spark, path, one(5), 2, ["who"], "day")
    bt.apply_batch(spark, path, one(6), 2, ["who"], "day")
    assert [(r.a, r.known_from, r.known_to) for r in spark.read.parquet(path).collect()] == [(6, 2, None)]
    with pytest.raises(ValueError):
        bt.apply_batch(spark, path, one(9), 1, ["who"], "day")
    assert bt.apply_batch(spark, path, one(1).limit(0), 3, ["who"], "day") == []
