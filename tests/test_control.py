"""Control charts step by step, and the same from a stream out of order."""

import datetime as dt
import math
import random
import statistics

from pyspark.sql import functions as F

from forecastops.operators import control as co
from forecastops.streaming import control as sc

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, k string, v double"


def calm():
    return F.col("window_start") < F.lit("2024-01-13").cast("timestamp")


def values(seed=4):
    rng = random.Random(seed)
    out = []
    for day in range(30):
        for k in ("a", "b", None):
            for _ in range(rng.randrange(1, 6)):
                shift = 1.5 if k == "a" and day > 18 else 0.0
                out.append((T0 + dt.timedelta(days=day, minutes=rng.randrange(1440)), k, rng.choice([None, rng.gauss(10 + shift, 1)])))
    return out + [(T0 + dt.timedelta(days=20), "late", 1.0)]


def expected(rows):
    out = {}
    for k in {r[1] for r in rows}:
        days = {}
        for ts, kk, v in rows:
            if kk == k and v is not None:
                days.setdefault(ts.date(), []).append(v)
        means = {d: sum(v) / len(v) for d, v in sorted(days.items())}
        calm = [v for d, v in means.items() if d < dt.date(2024, 1, 13)]
        high = low = 0.0
        for d, v in means.items():
            if not calm:
                out[k, d] = (v, None, None, None, -1)
                continue
            z = (v - statistics.mean(calm)) / max(statistics.stdev(calm), co.MIN_STD)
            high, low = max(0.0, high + z - co.SLACK), max(0.0, low - z - co.SLACK)
            out[k, d] = (v, z, high, low, 2 if abs(z) >= 3 else 1 if abs(z) >= 2 else 0)
    return out


def check(found, rows):
    want = expected(rows)
    got = {(r.k, r.window_start.date()): (r.value, r.z, r.cusum_high, r.cusum_low, r.sigma_level) for r in found}
    assert got.keys() == want.keys()
    for key, w in want.items():
        assert all((a is None and b is None) or math.isclose(a, b, abs_tol=1e-8) for a, b in zip(got[key], w)), key


def test_chart_step_by_step(spark):
    rows = values()
    found = co.control_chart(co.window_values(spark.createDataFrame(rows, SCHEMA).repartition(5), "ts", ["k"], "v"), ["k"], calm()).collect()
    check(found, rows)
    assert any(r.shifted for r in found if r.k == "a" and r.window_start > T0 + dt.timedelta(days=20))


def test_stream_out_of_order_equals_batch(spark, folder):
    rows = values(9)
    random.Random(1).shuffle(rows)
    for part in range(3):
        spark.createDataFrame(rows[part::3], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        sc.watch(stream, f"{folder}/out", "ts", ["k"], "v", delay="60 days")
        check(sc.chart(spark, f"{folder}/out", ["k"], calm()).collect(), [r for p in range(part + 1) for r in rows[p::3]])


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert co.control_chart(co.window_values(none, "ts", ["k"], "v"), ["k"], calm()).collect() == []
