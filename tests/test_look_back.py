"""Look-back views against a sum over each window."""

import datetime as dt
import random

import pytest

from forecastops.operators.features import customer_view_pit


@pytest.mark.parametrize("days", [7, 10, 28, 90])
def test_look_back_equals_the_window(spark, days):
    rng = random.Random(days)
    start = dt.date(2021, 1, 4)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), start + dt.timedelta(days=rng.randrange(200)), rng.choice([None, round(rng.uniform(0, 99), 2)]), rng.choice([None, 1.0, 2.5])) for _ in range(250)]
    rows += [(4, start + dt.timedelta(days=d), 0.1, 0.1) for d in range(0, 200)] + [(5, start, 1.0, 1.0)] * 3
    tx = spark.createDataFrame(rows, "customer_id int, tx_date date, revenue double, units double").repartition(4)
    monday = lambda d: d - dt.timedelta(days=d.weekday())
    want = {}
    for ts in {monday(r[1]) for r in rows}:
        for c in {r[0] for r in rows}:
            seen = [r for r in rows if r[0] == c and ts - dt.timedelta(days=days) <= r[1] < ts]
            if not seen:
                continue
            money, units = [r[2] for r in seen if r[2] is not None], [r[3] for r in seen if r[3] is not None]
            mean = lambda v: round(sum(v) / len(v), 6) if v else None
            dates = {r[1] for r in seen}
            want[c, ts] = (mean(money), len({monday(d) for d in dates}), (ts - max(dates)).days, round(sum(units), 6) if units else None, len(dates), mean(units))
    got = {}
    for r in customer_view_pit(tx, days).collect():
        short = lambda v: None if v is None else round(v, 6)
        got[r.customer_id, r.feature_ts] = (short(r.mean_revenue), r.active_weeks, r.idle_days, short(r.units_in_window), r.active_days, short(r.mean_units))
    assert got == want


def test_short_windows_are_refused(spark):
    with pytest.raises(ValueError):
        customer_view_pit(spark.createDataFrame([], "customer_id int, tx_date date, revenue double, units double"), 6)


def test_partitions_of_the_look_back_are_not_joined(spark):
    """Small partitions of weeks stay small: their events take far more memory than their bytes say."""
    from forecastops.operators.features import _look_back

    tx = spark.createDataFrame([(1, dt.date(2021, 1, 4), 1.0, 1.0)], "customer_id int, tx_date date, revenue double, units double")
    plan = _look_back(tx, 28)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan
