import random

import pytest

from forecastops.llm import language_mixture as lm


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.learning_rows(docs.filter("crc32(cast(doc_id as string)) % 4 != 2"), "doc_id", "text", "lang")
    return docs, *lm.learn(rows)


def test_held_out_accuracy(spark, learned):
    docs, languages, model = learned
    held = lm.identify(docs.filter("crc32(cast(doc_id as string)) % 4 = 2"), languages, model)
    n, right = held.count(), held.filter("lang_pred = lang").count()
    assert right / n > 0.97
    assert held.filter("score < 0 or score > 1").count() == 0


def test_mixtures(spark, learned):
    docs, languages, model = learned
    texts = {r.lang: r.text for r in docs.filter("length(text) > 3000").collect()}
    a, b = "en", "fr"
    mixed = (texts[a][:1500] + " " + texts[b][:500]) * 2
    share = dict(zip(languages, lm.mixtures([mixed], model)[0]))
    assert abs(share[a] - 0.75) < 0.1 and abs(share[b] - 0.25) < 0.1
    assert sum(x == 0 for x in share.values()) == len(languages) - 2
    single = dict(zip(languages, lm.mixtures([texts[a]], model)[0]))
    assert single[a] > 0.95


def test_blocks_do_not_change_results(learned, monkeypatch):
    docs, _, model = learned
    texts = [r.text for r in docs.limit(60).collect()] + ["x", "é", ""]
    whole = lm.mixtures(texts, model)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    assert abs(lm.mixtures(texts, model) - whole).max() < 1e-9
    random.Random(1).shuffle(texts)


def test_edges(spark, learned):
    _, languages, model = learned
    rows = [(1, None, "old"), (2, "", "old"), (3, "123 456 ...", "old"), (4, "the", "old"), (5, "the and of " * 30_000, "old"), (4, "the", "old"), (None, "the that with", "old"), (6, "日本", "old")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = lm.identify(docs, languages, model).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text and r.text[:3]): r for r in got}
    for k in ((1, None), (2, ""), (3, "123")):
        assert (by[k].lang_pred, by[k].score, by[k].lang_mix) == ("und", 0.0, [])
    assert by[(4, "the")].lang_pred == by[(5, "the")].lang_pred == "en" and by[(6, "日本")].lang_pred in languages
    assert lm.identify(docs.limit(0), languages, model).collect() == []
    none, empty = lm.learn(lm.learning_rows(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"), "doc_id", "text", "lang"))
    assert none == [] and [r.lang_pred for r in lm.identify(docs, none, empty).collect()] == ["und"] * len(rows)
