"""Upserts, sync, feature store, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forecastops import contracts as ct
from forecastops.functions.keys import model_uri_part, record_id
from forecastops.operators import feature_store as fs
from forecastops.operators import lifecycle as lc
from forecastops.sources import landing as la
from forecastops.sources.tables import read_many, read_or_empty, read_slice, require_rows
from forecastops.streaming import monitor as mo


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_path_touches_only_its_partitions(spark, folder):
    path = f"{folder}/t"
    schema = "k int, m string, v int"
    first = spark.createDataFrame([(1, "01", 1), (2, "01", 2), (3, "02", 3)], schema)
    la.upsert_path(spark, path, first, ["k", "m"], ["m"])
    before = {f for f in _files(path) if "m=02" in f}
    la.upsert_path(spark, path, spark.createDataFrame([(2, "01", 20), (4, "01", 4), (5, "03", 5)], schema), ["k", "m"], ["m"])
    got = spark.read.schema(schema).parquet(path).select("k", "m", "v")
    assert _rows(got) == [(1, "01", 1), (2, "01", 20), (3, "02", 3), (4, "01", 4), (5, "03", 5)]
    assert {f for f in _files(path) if "m=02" in f} == before


def _files(path):
    from pathlib import Path

    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_upsert_refuses_ambiguous_sources(spark, folder):
    twice = spark.createDataFrame([(1, "a"), (1, "a")], "k int, m string")
    with pytest.raises(ValueError, match="more than one row"):
        la.upsert_path(spark, f"{folder}/t", twice, ["k", "m"], ["m"])
    with pytest.raises(ValueError, match="outside the key"):
        la.upsert_path(spark, f"{folder}/t", twice, ["k"], ["m"])


def test_sync_snapshot_and_segment_folders(spark, folder):
    src, dst = f"{folder}/src", f"{folder}/dst"
    df = spark.createDataFrame([(1, "v1", 1.0), (2, "v1", 2.0), (1, "v2", 3.0)], "week int, version string, x double")
    df.write.parquet(src)
    la.create_like(spark, df, dst)
    assert spark.read.parquet(dst).count() == 0
    df.where("version = 'v1'").write.mode("append").parquet(dst)
    for _ in range(2):
        la.sync_path(spark, src, dst, ["version", "week"])
        assert _rows(spark.read.parquet(dst)) == _rows(df)
    la.snapshot(spark, src, f"{folder}/copy")
    assert _rows(spark.read.parquet(f"{folder}/copy")) == _rows(df)
    for part in (df.where("version = 'v1'"), df):
        la.write_by_segment(spark, part, f"{folder}/seg", "version")
    assert spark.read.parquet(f"{folder}/seg").count() == 3
    assert read_slice(spark, f"{folder}/seg", "version", ["v2"]).count() == 1
    more = df.withColumn("extra", F.lit(1))
    more.write.parquet(f"{folder}/more")
    assert set(read_many(spark, [src, f"{folder}/more"]).columns) == {"week", "version", "x", "extra"}
    assert read_or_empty(spark, f"{folder}/none", df.schema).isEmpty()
    with pytest.raises(ValueError, match="no rows"):
        require_rows(df.limit(0), "nothing")


def test_contract_order_types_and_unknown_columns(spark):
    df = spark.createDataFrame([("1", 2)], "prediction string, record_id int")
    assert ct.conform(df, ct.PREDICTIONS).schema == ct.PREDICTIONS
    with pytest.raises(ValueError, match="outside the contract"):
        ct.conform(df.withColumn("other", F.lit(1)), ct.PREDICTIONS)
    assert ct.empty_frame(spark, ct.DRIFT).isEmpty()


def test_record_id_with_absent_part(spark):
    r = spark.range(1).select(record_id(F.lit("a"), F.lit(None).cast("string"), F.lit(3)).alias("x"), record_id(F.lit("a"), F.lit(3)).alias("y")).first()
    assert len(r["x"]) == 64 and r["x"] != r["y"]


def test_feature_batches_merge_recreate_and_repeat(spark, folder):
    src = spark.createDataFrame([("b1", 1, 10), ("b1", 2, 20), ("b2", 2, 5), ("b2", 3, 7)], "b string, c int, v int")
    compute = lambda rows: rows.groupBy("c").agg(F.sum("v").alias("v"))
    for mode, want in (("merge", [(1, 10, "b1"), (2, 5, "b2"), (3, 7, "b2")]), ("recreate", [(2, 5, "b2"), (3, 7, "b2")])):
        root = f"{folder}/{mode}"
        for b in ("b1", "b1", "b2"):
            fs.run_batch(spark, src.where(F.col("b") == b), b, compute, root, ["c"], latest_mode=mode)
        assert _rows(fs.read_latest(spark, root).select("c", "v", "batch_id")) == want
        log = spark.read.parquet(f"{root}/runs")
        assert _rows(log.select("batch_id", "status", "source_rows", "feature_rows")) == [("b1", "PROCESSED", 2, 2), ("b2", "PROCESSED", 2, 2)]
        history = spark.read.parquet(f"{root}/history")
        assert _rows(fs.features_of_batch(history, "b1").select("c", "v")) == [(1, 10), (2, 20)]


def test_promotion_and_rollback_of_one_model(spark):
    rows = [(m, f"v{i}", dt.date(2024, 1, i)) for m in ("a", "b") for i in range(1, 5)]
    aliased = lc.alias_by_recency(spark.createDataFrame(rows, "model_name string, model_version string, created_on date"))
    alias = lambda df: {(r["model_name"], r["model_version"]): r["alias"] for r in df.collect()}
    got = alias(lc.promote(aliased, F.col("model_name") == "a"))
    assert (got["a", "v4"], got["a", "v3"], got["a", "v2"], got["b", "v4"]) == ("PRODUCTION", "BACKUP", None, "CANDIDATE")
    back = lc.roll_back(aliased)
    assert alias(back)["b", "v2"] == "PRODUCTION"
    assert _rows(lc.default_versions(back)) == [("a", "v2"), ("b", "v2")]
    uri = spark.range(1).select(model_uri_part(F.lit("models:/x/7"), "version").alias("v")).first()["v"]
    assert uri == "7"


def test_stream_in_steps_equals_batch(spark, folder):
    base = dt.datetime(2024, 1, 1)
    schema = "ts timestamp, seg string, y double, p double"
    rows = [(base + dt.timedelta(hours=5 * i), "ab"[i % 2], float(i % 7), float(i % 5)) for i in range(60)]
    for part in (rows[:20], rows[20:45], rows[45:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        sums = mo.windowed_sums(stream, "ts", "seg", "y", "p", delay="1 day")
        mo.land(sums, f"{folder}/sums", f"{folder}/cp", ["window_start", "seg"], ["seg"])
    batch = mo.windowed_sums(spark.read.parquet(f"{folder}/in"), "ts", "seg", "y", "p")
    cols = ["window_start", "seg", "n_rows", "wape", "rmse", "mae", "f1_binary"]
    rounded = lambda df: _rows(mo.window_metrics(df, "seg").select(*cols[:3], *[F.round(c, 9) for c in cols[3:]]))
    assert rounded(spark.read.parquet(f"{folder}/sums")) == rounded(batch)


def test_refresh_upserts_touched_entities(spark, folder):
    schema = "c int, v int"
    compute = lambda arrived: (
        spark.read.parquet(f"{folder}/in").join(arrived.select("c").distinct(), "c", "left_semi").groupBy("c").agg(F.sum("v").alias("v"), F.lit("all").alias("part"))
    )
    for part in ([(1, 1), (2, 2)], [(2, 5), (3, 3)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        mo.refresh(spark, spark.readStream.schema(schema).parquet(f"{folder}/in"), compute, f"{folder}/view", f"{folder}/cp", ["c", "part"], ["part"])
    assert _rows(spark.read.parquet(f"{folder}/view").select("c", "v")) == [(1, 1), (2, 7), (3, 3)]
