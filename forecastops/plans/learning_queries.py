"""Registered queries: boosted trees and successive halving per segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecastops.operators import boosting as bo
from forecastops.operators import halving as ha
from forecastops.operators import split as sp
from forecastops.operators import training as tr
from forecastops.plans.frames import ROW_IDS, stored_groups
from forecastops.plans.operations_queries import DRAWN, SEG, TWO
from forecastops.plans.registry import BASE, query, with_
from forecastops.plans.segment_queries import BUCKET

# --- boosted trees ----------------------------------------------------------------------------------------------------------

BINS, ROUNDS, DEPTH, RATE, PENALTY, LEAST = 8, 2, 2, 0.5, 1.0, 5

_PROBS = ", ".join(repr(i / BINS) for i in range(1, BINS))


def _boost_sql() -> list[str]:
    """One pair of expressions per level: sums with the best split of each node, and the rows moved to its children."""
    out = [
        f"edges AS (SELECT list_sort(list_distinct(quantile_cont(w_m1_total, [{_PROBS}]))) AS e1, list_sort(list_distinct(quantile_cont(sum_past_4_weeks, [{_PROBS}]))) AS e2 FROM grouped)",
        f"""r0 AS MATERIALIZED (SELECT customer_id, brand, week, stats_group AS seg, CAST(y AS DOUBLE) AS y, [len(list_filter(e1, lambda e: e < w_m1_total)), len(list_filter(e2, lambda e: e < sum_past_4_weeks))] AS x,
             CAST(SUM(CAST(ROUND(y / CAST({bo.UNIT!r} AS DOUBLE)) AS BIGINT)) OVER (PARTITION BY stats_group) AS DOUBLE) / COUNT(*) OVER (PARTITION BY stats_group) * CAST({bo.UNIT!r} AS DOUBLE) AS p, 1 AS node, CAST(0 AS DOUBLE) AS leaf FROM grouped, edges)""",
    ]
    last = "r0"
    for r in range(ROUNDS):
        for level in range(DEPTH):
            name = f"{r}_{level}"
            out += [
                f"h{name} AS (SELECT seg, node, f, x[f + 1] AS bin, SUM(CAST(ROUND((y - p) / CAST({bo.UNIT!r} AS DOUBLE)) AS BIGINT)) AS g, COUNT(*) AS n FROM {last}, (VALUES (0), (1)) AS t(f) WHERE node >= {2**level} GROUP BY ALL)",
                f"""c{name} AS (SELECT *, CAST(SUM(g) OVER upto AS DOUBLE) AS gl, SUM(n) OVER upto AS nl, CAST(SUM(g) OVER whole AS DOUBLE) AS gt, SUM(n) OVER whole AS nt FROM h{name}
                    WINDOW upto AS (PARTITION BY seg, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY seg, node, f))""",
                f"""s{name} AS MATERIALIZED (SELECT seg, node, f, bin, {RATE} * (gl * CAST({bo.UNIT!r} AS DOUBLE) / (nl + {PENALTY})) AS "left", {RATE} * ((gt - gl) * CAST({bo.UNIT!r} AS DOUBLE) / (nt - nl + {PENALTY})) AS "right"
                    FROM (SELECT *, gl * gl / (nl + {PENALTY}) + (gt - gl) * (gt - gl) / (nt - nl + {PENALTY}) - gt * gt / (nt + {PENALTY}) AS gain FROM c{name} WHERE nl >= {LEAST} AND nt - nl >= {LEAST})
                    WHERE gain > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY seg, node ORDER BY gain DESC, f, bin) = 1)""",
            ]
            down = f"""SELECT r.* REPLACE (CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CASE WHEN x[s.f + 1] <= s.bin THEN 0 ELSE 1 END END AS node,
                    CASE WHEN s.f IS NULL THEN leaf WHEN x[s.f + 1] <= s.bin THEN s."left" ELSE s."right" END AS leaf) FROM {last} r LEFT JOIN s{name} s ON s.seg = r.seg AND s.node = r.node"""
            if level + 1 == DEPTH:
                down = f"SELECT * REPLACE (p + leaf AS p, 1 AS node, CAST(0 AS DOUBLE) AS leaf) FROM ({down})"
            last = f"r{name}"
            out.append(f"{last} AS MATERIALIZED ({down})")
    return out


BOOST = _boost_sql()
SPLITS = " UNION ALL ".join(
    f"""SELECT seg AS stats_group, CAST({r} AS INTEGER) AS round, CAST(node AS INTEGER) AS node, CASE f WHEN 0 THEN 'w_m1_total' ELSE 'sum_past_4_weeks' END AS feature,
        CASE f WHEN 0 THEN e1[bin + 1] ELSE e2[bin + 1] END AS threshold, "left", "right" FROM s{r}_{d}, edges"""
    for r in range(ROUNDS)
    for d in range(DEPTH)
)


def _boosted(rows):
    edges = bo.quantile_edges(rows, TWO, BINS, exact=True)
    return bo.fit_boosted(rows, SEG, TWO, "y", edges, rounds=ROUNDS, depth=DEPTH, rate=RATE, penalty=PENALTY, min_rows=LEAST)


@query("grouped_boosting", with_([*BASE, *BOOST], SPLITS), '"threshold" "left" "right"')
def grouped_boosting(spark, sf):
    """The splits of two boosted trees of depth two per group."""
    return bo.splits(_boosted(stored_groups(spark, sf)), SEG, TWO)


@query("boosted_score", with_([*BASE, *BOOST], f"SELECT customer_id, brand, week, seg AS stats_group, p AS prediction FROM r{ROUNDS - 1}_{DEPTH - 1}"), "prediction")
def boosted_score(spark, sf):
    """Every row with the prediction of its group's trees."""
    rows = stored_groups(spark, sf)
    return bo.predict_boosted(rows.drop("prediction"), SEG, TWO, _boosted(rows)).select(*ROW_IDS, SEG, "prediction")


# --- successive halving -----------------------------------------------------------------------------------------------------

#: the sample is chosen by the week's place in the key, apart from the hash that chooses the test rows
SAMPLE = BUCKET.replace("CAST(customer_id AS VARCHAR) || '|' || brand", "brand || '|' || CAST(customer_id AS VARCHAR)")


def _halving_sql() -> list[str]:
    out = [
        f"halves AS (SELECT stats_group, w_m1_total AS x1, sum_past_4_weeks AS x2, y, {BUCKET} < 20 AS is_test, {SAMPLE} AS bucket FROM grouped)",
        f"draws(trial, ridge, u1, u2) AS (VALUES {', '.join(f'({t["trial"]}, CAST({t["ridge"]!r} AS DOUBLE), {int(0 in t["features"])}, {int(1 in t["features"])})' for t in DRAWN)})",
        "a0 AS (SELECT DISTINCT stats_group, trial FROM grouped, draws)",
    ]
    for k, percent in enumerate(ha.RUNGS):
        last = k + 1 == len(ha.RUNGS)
        out += [
            f"""m{k} AS (SELECT stats_group, COUNT(*) AS n, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, regr_sxx(y, x1) AS s11, regr_sxx(y, x2) AS s22, regr_sxy(x2, x1) AS s12,
                regr_sxy(y, x1) AS s1, regr_sxy(y, x2) AS s2 FROM halves WHERE NOT is_test AND bucket < {percent} GROUP BY 1)""",
            f"""b{k} AS (SELECT m{k}.*, trial, CASE WHEN u1 = 0 THEN 0 WHEN u2 = 0 THEN s1 / (s11 + ridge) ELSE ((s22 + ridge) * s1 - s12 * s2) / ((s11 + ridge) * (s22 + ridge) - s12 * s12) END AS b1,
                CASE WHEN u2 = 0 THEN 0 WHEN u1 = 0 THEN s2 / (s22 + ridge) ELSE ((s11 + ridge) * s2 - s12 * s1) / ((s11 + ridge) * (s22 + ridge) - s12 * s12) END AS b2
                FROM m{k} JOIN a{k} USING (stats_group) JOIN draws USING (trial) WHERE n >= 2)""",
            f"""j{k} AS (SELECT b.stats_group, CAST({k} AS INTEGER) AS rung, CAST(trial AS INTEGER) AS trial, n AS sample_size, COUNT(*) AS validation_size, SQRT(AVG(POWER(y - my - b1 * (x1 - m1) - b2 * (x2 - m2), 2))) AS val_rmse
                FROM b{k} b JOIN halves h ON h.stats_group = b.stats_group AND h.is_test AND h.bucket < {percent} GROUP BY b.stats_group, trial, n)""",
            f"""k{k} AS (SELECT *, place <= {"1" if last else f"CEIL(COUNT(*) OVER (PARTITION BY stats_group) / CAST(3 AS DOUBLE))"} AS kept FROM (
                SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY stats_group ORDER BY val_rmse, trial) AS INTEGER) AS place FROM j{k}))""",
            f"""t{k} AS (SELECT stats_group, trial FROM k{k} WHERE kept UNION ALL SELECT * FROM a{k} WHERE stats_group NOT IN (SELECT stats_group FROM k{k}))""",
            f"a{k + 1} AS (SELECT stats_group, trial FROM t{k} QUALIFY COUNT(*) OVER (PARTITION BY stats_group) > 1)",
        ]
    return out


HALVED = [*BASE, *_halving_sql()]
RUNG_ROWS = " UNION ALL ".join(f"SELECT stats_group, rung, trial, sample_size, validation_size, val_rmse, place, kept FROM k{k}" for k in range(len(ha.RUNGS)))


def _halved(spark, sf):
    rows = sp.random_split(stored_groups(spark, sf), ROW_IDS)
    return ha.halving_search(rows, SEG, TWO, "y", DRAWN, ["brand", "customer_id", "week"])


@query("halving_search", with_(HALVED, RUNG_ROWS), "val_rmse")
def halving_search(spark, sf):
    """Fifteen draws per group on 10, 30 and 100 percent of the rows, a third of them kept after each."""
    return _halved(spark, sf).drop("params")


@query("halving_best", with_(HALVED, f"SELECT * EXCLUDE (place, kept) FROM ({RUNG_ROWS}) WHERE place = 1 QUALIFY ROW_NUMBER() OVER (PARTITION BY stats_group ORDER BY rung DESC) = 1"), "val_rmse")
def halving_best(spark, sf):
    return ha.halving_best(_halved(spark, sf), SEG).drop("params")
