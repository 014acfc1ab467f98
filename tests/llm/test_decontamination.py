import hashlib
import random
import re

from forecastops.llm import decontamination as d

DOCS = "doc_id long, text string, term string, pos int"
ITEMS = "item_id long, text string, phrase string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for at in range(max(len(w) - width, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + width]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((str(i), len(w), len(hit), len({x for x in found if x is not None}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def result(spark, docs, items):
    df = d.contamination(spark.createDataFrame([(i, t, "t", 0) for i, t in docs], DOCS).repartition(3), spark.createDataFrame([(i, t, "p") for i, t in items], ITEMS))
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "a"] * 20 + [f"w{i}" for i in range(120)] + ["é", "日本", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 25, 40]))) for i in range(30)] + [(30, None), (31, ""), (32, "..."), (5, "the the the the the the the the the the the the"), (None, "unlisted words of an item"), (33, "unknown1 unknown2")]
    docs = []
    for i in range(120):
        t = text(rng.randrange(0, 60))
        if rng.random() < 0.6:
            other = rng.choice(items)[1] or ""
            part = other.split()
            a = rng.randrange(len(part) + 1)
            t += rng.choice([" ", ". ", "\n"]) + rng.choice([other.upper(), other, " ".join(part[a:])]) + rng.choice([" ", "-"]) + text(rng.randrange(0, 30))
        docs.append((i, t))
    docs += [(200, None), (201, ""), (202, "the " * 30_000), (203, "unlisted, WORDS of an item!"), (3, docs[3][1]), (4, "other text of a repeated id"), (None, items[12][1])]
    assert result(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a b")]) == []
    assert result(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_proximity(spark):
    phrase = "alpha beta gamma delta epsilon"
    docs = spark.createDataFrame([(1, f"x {phrase} y"), (2, "alpha beta one gamma two delta epsilon"), (3, "epsilon delta gamma beta alpha"), (4, "alpha " + "z " * 40 + "epsilon")], "doc_id long, text string")
    wins = d.windows(spark.createDataFrame([(7, phrase)], "item_id long, text string"))
    anchored = d.anchors(docs, wins.select("phrase", "n"))
    index = d.build_index(docs, anchored)
    assert {r.doc.id for r in d.phrase_matches(index, anchored).collect()} == {1}
    assert {r.doc.id for r in d.proximity_matches(index, anchored, 3).collect()} >= {1}
    assert not {3, 4} & {r.doc.id for r in d.proximity_matches(index, anchored, 3).collect()}
