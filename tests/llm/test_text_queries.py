"""The registered queries of the text operators against their SQL, and their plans."""

import re

import pytest

from compare import connect, difference, duck_rows, spark_rows
from forecastops.llm.queries import ORACLES, QUERIES

NATIVE = ("op4", "op5", "op7", "op9", "op10")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark):
    folder = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, folder)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
    if name.split("_")[0] in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)
    got = spark_rows(df)
    table = {"op2": "pages", "op3": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    assert len(got[1]) == spark.read.parquet(f"{folder}/{table}.parquet").count()
    if name in ORACLES:
        assert difference(got, duck_rows(connect(folder), ORACLES[name])) is None


def test_every_operator_has_a_query():
    assert sorted({int(n.split("_")[0][2:]) for n in QUERIES}) == list(range(1, 14))
