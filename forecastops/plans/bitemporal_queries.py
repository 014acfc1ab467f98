"""Registered queries: features with the day they describe and the batches that knew them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecastops.operators import bitemporal as bt
from forecastops.plans.registry import query, with_
from forecastops.session import shared_folder

BATCHES, BUCKETS = 3, 16

#: a third of the orders arrives with each batch, whatever their date
KNOWN = f"""known AS (SELECT b AS batch, o_custkey AS customer_id, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month, COUNT(*) AS n_orders, MAX(o_totalprice) AS largest
  FROM orders, (SELECT UNNEST(range(1, {BATCHES + 1})) AS b) WHERE o_orderkey % {BATCHES} < b GROUP BY ALL)"""


def _history(spark, sf) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), "o_totalprice")
    path = f"{shared_folder(spark)}/bitemporal-{uuid.uuid4().hex}"
    for batch in range(1, BATCHES + 1):
        seen = orders.where(F.col("o_orderkey") % BATCHES < batch)
        rows = seen.groupBy("customer_id", "month").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("largest"))
        bt.apply_batch(spark, path, rows, batch, ["customer_id"], "month", buckets=BUCKETS)
    return spark.read.parquet(path)


@query("feature_bitemporal", with_([KNOWN], "SELECT customer_id, month, n_orders, largest FROM known WHERE batch = 2 AND month <= DATE '1999-06-30' QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY month DESC) = 1"), "largest")
def feature_bitemporal(spark, sf):
    """What the second of three batches knew about June 1999."""
    return bt.as_of(_history(spark, sf), 2, F.lit("1999-06-30").cast("date"), ["customer_id"], "month")


@query(
    "feature_validity",
    with_(
        [KNOWN, "steps AS (SELECT *, LAG(struct_pack(n := n_orders, l := largest)) OVER (PARTITION BY customer_id, month ORDER BY batch) AS before FROM known)"],
        """SELECT customer_id, month, n_orders, largest, batch AS known_from, LEAD(batch) OVER (PARTITION BY customer_id, month ORDER BY batch) AS known_to
           FROM steps WHERE before IS NULL OR before.n <> n_orders OR before.l <> largest""",
    ),
    "largest",
)
def feature_validity(spark, sf):
    """Every feature row with the batches that it held in."""
    return _history(spark, sf).drop("bucket")
