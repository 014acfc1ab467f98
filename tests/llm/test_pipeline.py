"""Each stage of the pipeline against a brute-force version of what it is to keep."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from forecastops.llm import language_mixture as lm
from forecastops.session import store
from test_decontamination import brute as contaminated
from test_ngram_jaccard import brute as grouped
from test_secret_scan import brute as secret_rows


@pytest.fixture(scope="module")
def given(spark):
    """The given documents with rows of every odd kind, and columns whose names the stages use themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    texts = {r.doc_id: r.text for r in docs.collect()}
    some = max(texts.values(), key=len)
    # rows that repeat an id all hold one text, so which of them stays does not show
    rows = [(9001, None, "en", "x", 0), (9002, "", None, None, 0), (9003, "12 34 ...", "en", None, 9), (9004, some, "en", None, 5), (9004, some, "en", None, 5), (None, some + " x", "en", "x", 5)]
    rows += [(9005, "The password = hunter2222 of and in the end", None, "s1", 43)]
    extra = spark.createDataFrame(rows, docs.schema)
    whole = docs.unionByName(extra).withColumns({"copies": F.lit(7), "score": F.lit("s"), "doc": F.lit(1.5), "doc_key": F.lit(None).cast("string")})
    return store(whole)


def kept(df):
    return sorted(((str(r.doc_id), r.text) for r in df.collect()), key=str)


def test_every_stage(spark, sf, given):
    stages = dict(cp.STAGES)
    names = given.columns
    languages, model = lm.learn(lm.learning_rows(given, "doc_id", "text", "lang"))
    predicted = lm.identify(given.drop("score"), languages, model).collect()
    one = store(stages["language"](spark, given, sf))
    assert one.columns == names
    assert kept(one) == sorted(((str(r.doc_id), r.text) for r in predicted if r.lang_pred != "und" and r.score >= 0.5), key=str)
    assert not {"9001", "9002", "9003"} & {i for i, _ in kept(one)} and one.count() > 0.9 * given.count()

    two = store(stages["near_copies"](spark, one, sf))
    rows = [(r.doc_id, r.text) for r in one.collect()]
    first = {i for i, _, c in grouped(rows) if i == c}
    want = {(str(i), t) for i, t in rows if i is None or i in first}
    assert two.columns == names and kept(two) == sorted(want, key=str)

    three = store(stages["benchmark"](spark, two, sf))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in two.collect()]
    bad = {i for i, *_, hit in contaminated(rows, items) if hit}
    assert three.columns == names and kept(three) == sorted(((str(i), t) for i, t in rows if str(i) not in bad), key=str)

    four = store(stages["secrets"](spark, three, sf))
    rows = [(r.doc_id, r.text, r.source) for r in three.collect()]
    live = {str(r[0]): [tuple(map(int, s.split(":")[1:])) for s in r[8].split(",") if s] for r in secret_rows(rows)}
    want = []
    for i, t, _ in rows:
        out, at = "", 0
        for s, e in sorted(live[str(i)]):
            out += t[at:s] + "[secret]" if s >= at else ""
            at = max(at, e)
        want.append((str(i), out + t[at:]))
    assert four.columns == names and kept(four) == sorted(want, key=str)
    before = {str(r.doc_id): r.n_chars for r in three.collect()}
    assert all(r.n_chars == (len(r.text) if live[str(r.doc_id)] else before[str(r.doc_id)]) for r in four.collect())

    five = store(stages["mix"](spark, four, sf))
    rows = five.collect()
    assert set(names) <= {*five.columns} and "position" in five.columns
    assert {(str(r.doc_id), r.text) for r in rows} <= set(kept(four))
    assert all(1 <= r.copies <= 2 and 0 <= r.position <= 1 for r in rows)
    size = {(str(i), t): len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in kept(four)}
    taken = sum(r.copies * size[(str(r.doc_id), r.text)] for r in rows)
    assert abs(taken - 1.5 * sum(size.values())) < sum(sorted(size.values())[-40:])
    assert [r.position for r in rows] == sorted(r.position for r in rows)


def test_empty_documents(spark, sf, given):
    docs = given.limit(0)
    for name, stage in cp.STAGES:
        docs = store(stage(spark, docs, sf))
        assert docs.count() == 0, name
