"""Benchmark passages in training text, found through a distributed positional inverted index.

The index holds postings (term, document, position) of the terms that are rarest in the corpus among the terms of some
benchmark window. A window is looked up from its rarest term: the postings, moved back by the term's offset in the window,
are intersected with those of the next rarest term, and the words around the posting decide on the exact phrase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecastops.llm.text import ascii_lower
from forecastops.session import lookup, store

#: Fixed value: what separates words of letters and digits; anything beyond ASCII is part of a word.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a benchmark window.
WIDTH = 10


def terms(text: Column) -> Column:
    """Lower-cased words of letters, digits and characters beyond ASCII; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item, phrase, n) for each distinct window of each item: ``width`` words in a row, or the whole of a shorter item.

    Words of a phrase are separated by blanks. Items without words have no window.
    """
    rows = items.select(F.col(id_col).cast("string").alias("item"), terms(F.col(text_col)).alias("_w")).filter(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - width, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last)).alias("_at")
    rows = rows.select("item", "_w", starts).select("item", F.slice(F.col("_w"), F.col("_at") + 1, F.lit(width)).alias("_p"))
    return rows.select("item", F.array_join("_p", " ").alias("phrase"), F.size("_p").alias("n")).distinct()


def anchors(docs: DataFrame, phrases: DataFrame, text_col: str = "text") -> DataFrame:
    """(phrase, n, term, at, term2, at2): the two places of each phrase whose terms are rarest in ``docs``.

    ``phrases`` has phrase and n. A phrase with a term that no document has is left out, as it cannot occur. term2 and at2
    are null for phrases of one word. Terms are counted over all documents, combined on the map side.
    """
    places = phrases.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("at", "term"))
    wanted = lookup(places.select("term").distinct())
    counts = docs.select(F.explode(terms(F.col(text_col))).alias("term")).join(wanted, "term").groupBy("term").agg(F.count("*").alias("count"))
    rare = F.array_sort(F.collect_list(F.struct("count", "at", "term")))
    ranked = places.join(store(counts), "term").groupBy("phrase", "n").agg(rare.alias("rare")).filter(F.size("rare") == F.col("n"))
    first, second = F.get("rare", F.lit(0)), F.get("rare", F.lit(1))
    return ranked.select("phrase", "n", first["term"].alias("term"), first["at"].alias("at"), second["term"].alias("term2"), second["at"].alias("at2"))


def build_index(docs: DataFrame, anchored: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Postings (doc, term, pos, from, near) of the anchor terms, stored in the shared folder.

    ``doc`` is (id, text hash), so rows that repeat an id are told apart. ``near`` has the words up to ``width`` - 1 places
    either side of a posting of a first anchor, beginning at word ``from``.
    """
    firsts = anchored.select("term", F.lit(True).alias("first"))
    listed = firsts.unionByName(anchored.filter("term2 is not null").select(F.col("term2").alias("term"), F.lit(False).alias("first")))
    listed = lookup(listed.groupBy("term").agg(F.max("first").alias("first")))
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text")).alias("doc"), terms(F.col(text_col)).alias("_w"))
    rows = keyed.select("doc", "_w", F.posexplode("_w").alias("pos", "term")).join(listed, "term")
    start = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    near = F.when(F.col("first"), F.slice(F.col("_w"), start + 1, F.col("pos") - start + width))
    return store(rows.select("doc", "term", "pos", start.alias("from"), near.alias("near")))


def _first_hits(index: DataFrame, anchored: DataFrame) -> DataFrame:
    hits = index.filter("near is not null").join(lookup(anchored), "term")
    return hits.withColumn("start", F.col("pos") - F.col("at"))


def phrase_matches(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc, start, n, phrase): every exact occurrence of a phrase."""
    hits = _first_hits(index, anchored).filter("start >= 0")
    both = hits.filter("term2 is not null").withColumn("pos2", F.col("start") + F.col("at2"))
    second = index.select(F.col("doc").alias("doc2"), F.col("term").alias("its_term"), F.col("pos").alias("its_pos"))
    both = both.join(second, (F.col("doc") == F.col("doc2")) & (F.col("term2") == F.col("its_term")) & (F.col("pos2") == F.col("its_pos")), "left_semi").drop("pos2")
    aligned = both.unionByName(hits.filter("term2 is null"))
    found = F.array_join(F.slice("near", F.greatest(F.col("start") - F.col("from"), F.lit(0)) + 1, F.col("n")), " ")
    return aligned.filter(found == F.col("phrase")).select("doc", "start", "n", "phrase").distinct()


def proximity_matches(index: DataFrame, anchored: DataFrame, slack: int = 5) -> DataFrame:
    """(doc, start, phrase): places where the two rarest terms of a phrase stand in order, at most ``slack`` words off.

    The first term's place gives ``start``. The lists are intersected per document and cell of ``slack`` + 1 words, so
    a term that fills a document meets only its neighbours.
    """
    cell = slack + 1
    hits = _first_hits(index, anchored).filter("term2 is not null")
    hits = hits.withColumn("wanted", F.col("start") + F.col("at2")).select("doc", "start", "at", "at2", "pos", "phrase", "term2", "wanted", F.explode(F.array(*[F.floor(F.col("wanted") / cell) + d for d in (-1, 0, 1)])).alias("cell"))
    second = index.select("doc", F.col("term").alias("term2"), F.col("pos").alias("pos2"), F.floor(F.col("pos") / cell).alias("cell"))
    near = hits.join(second, ["doc", "term2", "cell"]).filter((F.abs(F.col("pos2") - F.col("wanted")) <= slack) & ((F.col("pos2") > F.col("pos")) == (F.col("at2") > F.col("at"))))
    return near.select("doc", "start", "phrase").distinct()


def find_phrases(docs: DataFrame, wins: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc, start, n, phrase): every occurrence in ``docs`` of the phrases of ``wins``; ``doc`` is (id, text hash)."""
    anchored = store(anchors(docs, wins.select("phrase", "n").distinct(), text_col))
    return store(phrase_matches(build_index(docs, anchored, id_col, text_col, width), anchored))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit inside any occurrence of a window of ``width`` item words, or of a whole shorter item.
    ``n_items`` counts items with an occurring window, ``items_sha256`` digests their ids, sorted as strings and joined by
    commas. Null and empty texts have no words; repeated rows stand for themselves; an item without an id can hit but is not
    listed; empty tables give no rows or no hits. Texts are read three times, for counts, postings and word totals, and
    never shuffled; the sides that are broadcast grow with the benchmark alone and are checked before.
    """
    wins = store(windows(items, item_id_col, item_text_col, width))
    matches = find_phrases(docs, wins, id_col, text_col, width)
    order = Window.partitionBy("doc").orderBy("start", "end")
    ends = matches.select("doc", "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    covered = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hit = ends.select("doc", F.greatest(covered, F.lit(0)).alias("new")).groupBy("doc").agg(F.sum("new").alias("n_hit"))
    named = matches.select("doc", "phrase").distinct().join(lookup(wins.select("item", "phrase")), "phrase").groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = store(hit.join(named, "doc", "left")).withColumnRenamed("doc", "_found")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash"), F.size(terms(F.col(text_col))).cast("long").alias("n_words"))
    rows = rows.join(found, F.col("_id").eqNullSafe(F.col("_found.id")) & (F.col("_hash") == F.col("_found.text")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        F.col("_id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
