"""Bucketed tables join without a shuffle and with the same rows."""

import pytest

from forecastops.sources import buckets as bu


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def tables(spark, folder):
    left = spark.createDataFrame([(i, i % 7 if i % 5 else None, i) for i in range(500)], "id int, week int, p int").repartition(3)
    right = spark.createDataFrame([(i, i % 7 if i % 5 else None, -i) for i in range(0, 700, 2)], "id int, week int, y int")
    names = [bu.write_bucketed(left, "bucket_left", ["id", "week"], 4, f"{folder}/l"), bu.write_bucketed(right, "bucket_right", ["id", "week"], 4, f"{folder}/r")]
    yield names
    for n in names:
        spark.sql(f"DROP TABLE {n}")


@pytest.mark.parametrize("how, rows", [("inner", 200), ("left", 500), ("full", 650)])
def test_join_without_exchange(spark, tables, how, rows):
    joined = bu.bucket_join(spark, *tables, ["id", "week"], how)
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert joined.count() == rows
    assert joined.where("p is not null and y is not null and p <> -y").count() == 0


def test_writing_again_replaces(spark, tables, folder):
    few = spark.createDataFrame([(2, 2, 9)], "id int, week int, p int")
    bu.write_bucketed(few, tables[0], ["id", "week"], 4, f"{folder}/l")
    assert [tuple(r) for r in bu.bucket_join(spark, *tables, ["id", "week"]).collect()] == [(2, 2, 9, -2)]


def test_different_buckets_are_refused(spark, tables, folder):
    other = bu.write_bucketed(spark.table(tables[1]), "bucket_other", ["id", "week"], 2, f"{folder}/o")
    plain = spark.range(3).select("id")
    plain.write.mode("overwrite").option("path", f"{folder}/p").saveAsTable("bucket_none")
    try:
        for right, keys in ((other, ["id", "week"]), ("bucket_none", ["id"]), (tables[1], ["id"])):
            with pytest.raises(ValueError):
                bu.bucket_join(spark, tables[0], right, keys)
    finally:
        spark.sql("DROP TABLE bucket_other")
        spark.sql("DROP TABLE bucket_none")
