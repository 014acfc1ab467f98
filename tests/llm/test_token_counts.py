import os

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecastops.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


@given(st.lists(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \n\t'’“”…€Жяs\x1c\x1f\x85\xa0"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
@settings(max_examples=300, deadline=None)
def test_block_counts_equal_the_library(texts):
    tokenizer = tc._library(PATH)[0]
    assert tc.block_counts(PATH, texts).tolist() == [expected(tokenizer, t) for t in texts]


def test_every_settled_code_point(library):
    points = [chr(c) for c in [*range(0x250), *range(0x400, 0x460), *range(0x2000, 0x2100)]]
    texts = [f"a{c}b {c}{c} 1{c}\n{c} x" for c in points]
    assert tc.block_counts(PATH, texts).tolist() == [expected(library, t) for t in texts]


def test_rows(spark, library):
    texts = [None, "", " ", "a", "a", "x<|endoftext|>y <|endoftext|>", "it's  two\n\n lines ", "word " * 60_000, "日本 ١٢"]
    docs = spark.createDataFrame([(i, t, 0, "n") for i, t in enumerate(texts)] + [(3, "a", 0, "n")], "doc_id long, text string, n_tokens int, id string")
    rows = tc.token_counts(docs, PATH).collect()
    assert len(rows) == 10
    for r in rows:
        t = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), expected(library, t), expected(library, t) > 512)
    assert tc.token_counts(docs.limit(0), PATH).collect() == []


def test_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(docs, PATH).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}
