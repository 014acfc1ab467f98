import random
import re

import numpy as np
import pandas as pd
import pytest

from forecastops.llm import ngram_jaccard as nj
from forecastops.llm.components import components

SCHEMA = "doc_id long, text string, n int, comp string"


def sets(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} - {()} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    """Components by comparing all pairs."""
    grams = {}
    for i, t in rows:
        grams.setdefault(i, []).append(sets(t))
    parent = {i: i for i in grams}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in grams if i is not None)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in grams[i] for b in grams[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted((i if i is not None else -1, len(sets(t)), -1 if i is None else root(i)) for i, t in rows)


def result(spark, rows):
    df = nj.join_groups(spark.createDataFrame([(i, t, 0, "c") for i, t in rows], SCHEMA).repartition(3))
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(190)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    parent = {}
    for a, b in links:
        if a != b:
            for x in (a, b):
                parent.setdefault(x, x)
            ra, rb = a, b
            while parent[ra] != ra:
                ra = parent[ra]
            while parent[rb] != rb:
                rb = parent[rb]
            parent[max(ra, rb)] = min(ra, rb)

    def root(x):
        return x if parent[x] == x else root(parent[x])

    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sets_equal_their_words():
    texts = ["", None, " \t\n", "One", "one  TWO\x0bthree\x0cfour", "a b c d e", "a b c d e a b c d e a", "É É é a\x1cb c d e f g", "x " * 50]
    for text, (grams, digest) in zip(texts, nj.shingle_sets(pd.Series(texts))):
        assert len(grams) == len(sets(text)) and bool(digest) == bool(sets(text))
    (a, d1), (b, d2), (c, d3) = nj.shingle_sets(pd.Series(["The cat sat on THE mat ", "the\ncat sat on the mat", "the cat sat on a mat"]))
    assert np.array_equal(a, b) and d1 == d2 and d1 != d3


def test_required_overlap():
    for nx in range(1, 60):
        for ny in range(1, 60):
            least = next((o for o in range(1, min(nx, ny) + 1) if 100 * o >= 75 * (nx + ny - o)), None)
            if least is not None:
                assert nj.required(nx, ny) == least


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows, at = [], 0
    for group in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 40, 90]))]
        if group % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 2, 5, 14])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                copy = copy[: max(1, int(len(copy) * 0.8))]
            rows.append((at * 7 % 1009, " ".join(copy)))
            at += 1
    # chains whose ends are not linked themselves
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for step in range(6):
        rows.append((2000 - step, " ".join(chain[step * 4 : step * 4 + 40])))
    assert result(spark, rows) == brute(rows)


def test_hot_group_of_near_copies(spark):
    """Copies that are each linked with the base only, and not with one another."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = [(50, " ".join(base))]
    for i in range(60):
        copy = list(base)
        copy[10 + (i * 7) % 40] = f"x{i}"
        rows.append((100 + i, " ".join(copy)))
    rows += [(1000 + i, " ".join(base)) for i in range(40)] + [(3000 + i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(30))) for i in range(30)]
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (None, "one two"), (None, None), (7, "w " * 30_000), (8, "w " * 29_000), (4, "one two"), (9, "a b c d e"), (10, "a b c d e")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []
    # rows that repeat an id are one document, even where their texts differ
    got = result(spark, [(1, "p q r s t u"), (2, "p q r s t u"), (2, "k l m n o p q"), (5, "k l m n o p q")])
    assert {c for _, _, c in got} == {1}


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(0, 900)).astype(np.uint64))
        y = np.union1d(rng.permutation(x)[: rng.integers(0, len(x) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 300)).astype(np.uint64))
        differing = sum(int(v).bit_count() for v in (nj.parity_bits(x) ^ nj.parity_bits(y)).view(np.uint64))
        assert len(nj.parity_bits(x)) == nj.PARITY and differing <= len(np.setxor1d(x, y))


def test_hot_group_just_below_the_similarity(spark):
    """Documents that share their lists with all others and link with few: parity bits rule pairs out, links stay."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(70)]
    rows = []
    for i in range(70):
        copy = list(base)
        for at in rng.sample(range(70), rng.choice([1, 2, 3])):
            copy[at] = f"x{rng.randrange(200)}"
        rows.append((i, " ".join(copy)))
    # one id of two texts has no parity bits, and still links with both
    rows += [(500, rows[3][1]), (500, " ".join(f"c{i}" for i in range(40))), (501, " ".join(f"c{i}" for i in range(41)))]
    assert result(spark, rows) == brute(rows)


def test_pair_is_made_once(spark):
    """Copies with changes that do not reach the similarity: few rows for each pair, not one for each n-gram they share."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(600)]
    rows = []
    for i in range(24):
        words = list(base)
        for at in rng.sample(range(600), 22):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    grams = [sets(t) for _, t in rows]
    assert not any(100 * len(a & b) >= 75 * len(a | b) for k, a in enumerate(grams) for b in grams[:k])
    docs = spark.createDataFrame(rows, "id long, text string")
    heads = nj.described(docs, nj.frequency_table(docs)).filter("n > 0")
    lists = heads.select("id", "n", nj.F.size("head").alias("merged"), nj.F.explode("head").alias("gram"), nj.F.col("id").alias("comp"))
    lists = lists.join(lists.groupBy("gram").count().filter("count > 1").select("gram"), "gram")
    found = lists.collect()
    postings = [{r.gram for r in found if r.id == i} for i in range(24)]
    shared = sum(len(a & b) for k, a in enumerate(postings) for b in postings[:k])
    nodes = nj.store(nj._nodes(lists, nj._parities(heads)))
    met = nj._meetings(nodes, nj.PERCENT).collect()
    made = {(r.x.id, r.y.id) for r in met}
    # a row for each shared n-gram would be ``shared`` rows
    assert shared > 20 * 276 and len(met) < 5 * 276, (shared, len(met))
    # every pair that meets in enough lists is among them and is found, and no other
    n = {r.id: (r.n, len(r.head)) for r in heads.collect()}
    least = lambda a, b: max(1, nj.required(n[a][0], n[b][0]) - max(n[a][0] - n[a][1], n[b][0] - n[b][1]))
    enough = {(a, b) for b in range(24) for a in range(b) if len(postings[a] & postings[b]) >= least(a, b)}
    assert enough <= made and {(r.a, r.b) for r in nj._between_components(lists, nj._parities(heads), nj.PERCENT).collect()} <= enough
    assert result(spark, rows) == brute(rows)


def test_python_gets_texts_in_small_batches(spark, monkeypatch):
    """3,000 texts of 5 kB came to Python as one batch of 15 MB; a batch's size decides the memory of executor and worker."""
    name, largest, given = "spark.sql.execution.arrow.maxBytesPerBatch", [], nj.described

    def noted(docs, *args, **named):
        sizes = docs.mapInPandas(lambda batches: (pd.DataFrame({"n": [b["text"].str.len().sum()]}) for b in batches), "n long")
        largest.append(sizes.agg({"n": "max"}).first()[0])
        return given(docs, *args, **named)

    monkeypatch.setattr(nj, "described", noted)
    before = spark.conf.get(name, None)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(concat(lpad(id, 9, 'w'), ' '), 500) as text")
    assert nj.join_groups(docs).count() == 3000
    assert largest and max(largest) < 5 << 20
    assert spark.conf.get(name, None) == before
