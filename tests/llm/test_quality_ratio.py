import math
import random
import re
from collections import Counter

import xxhash

from forecastops.llm import quality_ratio as q

SCHEMA = "doc_id long, text string, bin int, n_words int, score string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p + k for at in places.values() if len(at) > 1 for p in at for k in range(8)}
    n, repeat = len(words), len(covered)
    failed = n < 20 or 100 * repeat > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed)


def grams(text, bins):
    words = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in WORD.findall(text or "")]

    def then(a, b):
        first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)
        return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=first)

    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    return [signed(h) % bins for h in words + [then(a, b) for a, b in zip(words, words[1:])]]


def texts():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5)))
    out = [None, "", " \n\t", "one", "a b\na b\n\n a b\nc", "x | y # z <b> & 100%"]
    for _ in range(40):
        words = [word() for _ in range(rng.randrange(1, 90))]
        if rng.random() < 0.5:
            at = rng.randrange(len(words))
            words = words[:at] + words[max(0, at - rng.randrange(5, 20)) : at] * rng.randrange(1, 4) + words[at:]
        out.append(rng.choice([" ", "\n", "  "]).join(words) + rng.choice(["", "\nsame line\nsame line"]))
    return [*out, "again " * 20_000, "é" * 50_000]


def test_against_brute_force(spark):
    given = list(enumerate(texts())) + [(3, "one"), (None, "w " * 30)]
    docs = spark.createDataFrame([(i, t, 1, 1, "s") for i, t in given], SCHEMA).repartition(3)
    good = {i for i, _ in given if i is not None and i % 3 == 0}
    trusted = spark.createDataFrame([(i,) for i in good] + [(None,), (6,), (6,)], "doc_id long")
    bins = 512
    target, raw = Counter(), Counter()
    for i, t in given:
        raw.update(grams(t, bins))
        target.update(grams(t, bins) if i in good else [])
    nt, na = sum(target.values()), sum(raw.values())
    ratio = {b: math.log((target[b] + 1) / (nt + bins)) - math.log((raw[b] + 1) / (na + bins)) for b in range(bins)}
    want = []
    for i, t in given:
        found = grams(t, bins)
        score = sum(ratio[b] for b in found) / len(found) if found else 0.0
        want.append((str(i), *rules(t), round(score, 6), not rules(t)[-1] and score >= -0.05))
    got = q.quality(docs, trusted, bins=bins, threshold=-0.05).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(((str(r.doc_id), *[r[n] for n in names], round(r.score, 6), r.kept) for r in got), key=str) == sorted(want, key=str)


def test_without_trusted_or_documents(spark):
    docs = spark.createDataFrame([(1, "word " + " ".join(map(str, range(30))), 1, 1, "s"), (2, "short", 1, 1, "s")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long")
    assert {r.doc_id: (r.score, r.kept) for r in q.quality(docs, none).collect()} == {1: (0.0, True), 2: (0.0, False)}
    assert q.quality(docs.limit(0), none).collect() == []


def test_junk_scores_below_prose(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.quality(docs, labels.filter("quality = 1 and toxic = 0").select("doc_id")).join(labels, "doc_id").filter("not base_failed")
    kept = {r.quality: r.share for r in rows.groupBy("quality").agg({"kept": "count"}).withColumnRenamed("count(kept)", "share").collect()}
    assert rows.filter("quality = 1 and toxic = 0 and not kept").count() == 0, kept
