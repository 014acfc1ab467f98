"""Quality rules of documents and the likelihood ratio between trusted and raw text.

Words and word pairs are hashed into a fixed number of bins. Two smoothed multinomials over the bins are estimated, one from
trusted documents and one from all; a document's score is the log-likelihood ratio of its n-grams, divided by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.llm.text import WORD, words
from forecastops.session import small_side, store

#: Bins of the hashed n-grams; the table of ratios has this many rows at most, whatever the size of the corpus.
BINS = 1 << 16
#: Count that smoothing adds to each bin.
SMOOTHING = 1.0
#: A document passes with this mean log ratio per n-gram or more. Of the labelled documents at hand it keeps all good ones and
#: drops nineteen of twenty bad ones.
THRESHOLD = -0.2
#: Words of a window that counts as repeated when it is found twice.
WINDOW = 8


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    rest = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, rest), F.slice(hashes, step + 1, rest), lambda a, b: F.xxhash64(a, b))


def _hashed(docs: DataFrame) -> DataFrame:
    """Adds the hashes of words, pairs and 8-word windows. Hashes of 2, 4 and 8 words are built from halves."""
    docs = docs.withColumn("_h1", F.transform(words(F.col("_text")), lambda w: F.xxhash64(w)))
    return docs.withColumn("_h2", _pairs(F.col("_h1"), 1))


def _ngram_bins(bins: int) -> Column:
    return F.transform(F.concat("_h1", "_h2"), lambda h: F.pmod(h, F.lit(bins)).cast("int"))


def _covered(windows: Column, width: int) -> Column:
    """Words in windows whose hash occurs twice or more."""
    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ranked: Column) -> Column:
        twice = F.filter(ranked, lambda x, j: (F.get(ranked, j - 1)["h"] == x["h"]) | (F.get(ranked, j + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def add(so_far: Column, at: Column) -> Column:
        return F.struct((at + width).alias("end"), (so_far["n"] + at + width - F.greatest(so_far["end"], at)).alias("n"))

    # the array of one element binds the sorted windows to a name, so that they are sorted once
    found = F.element_at(F.transform(F.array(ranked), starts), 1)
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(found, nothing, add, lambda x: x["n"])


def bin_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, smoothing: float = SMOOTHING) -> DataFrame:
    """(bin, ratio): log of the bin's probability in trusted documents over that in all documents.

    ``trusted`` holds the ids of trusted documents, one column. Every document counts as raw text. Bins that no document
    has are absent. Counting combines on the map side, so a shuffle moves at most ``bins`` rows per task.
    """
    ids = small_side(trusted.select(F.col(trusted.columns[0]).alias("_trusted")).filter("_trusted is not null").distinct())
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(ids, F.col("_id") == F.col("_trusted"), "left")
    rows = _hashed(rows).select(F.col("_trusted").isNotNull().cast("long").alias("t"), F.explode(_ngram_bins(bins)).alias("bin"))
    counts = store(rows.groupBy("bin").agg(F.sum("t").alias("in_trusted"), F.count("*").alias("in_all")))
    totals = counts.agg(F.sum("in_trusted").alias("t"), F.sum("in_all").alias("a")).first()

    def log_share(count: str, total) -> Column:
        return F.log((F.col(count) + smoothing) / F.lit(float((total or 0) + smoothing * bins)))

    # without trusted documents nothing is known against any n-gram
    ratio = log_share("in_trusted", totals.t) - log_share("in_all", totals.a) if totals.t else F.lit(0.0)
    return counts.select("bin", ratio.alias("ratio"))


def quality(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    ``n_repeat_words`` counts words in 8-word windows found twice or more in the text; ``base_failed`` means fewer than 20
    words or more than 30 % repeated ones. ``score`` is the mean log ratio per n-gram, 0 without n-grams. ``kept`` asks for a
    passed base and a score of ``threshold`` or more. Null and empty texts have no words and fail; repeated rows stand for
    themselves; an empty table gives no rows. Whole texts are scored; each n-gram meets the ratios in a broadcast join of
    fixed size and a document's sum is complete before it is shuffled.
    """
    ratios = F.broadcast(store(bin_ratios(docs, trusted, id_col, text_col, bins, smoothing)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _hashed(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text.alias("_text")))
    rows = rows.withColumn("_h8", _pairs(_pairs(F.col("_h2"), 2), 4))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "_row", "_id", F.size("_h1").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.when(F.instr("_text", "\n") > 0, F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_h8")) < F.size("_h8"), _covered(F.col("_h8"), WINDOW)).otherwise(0).cast("long").alias("n_repeat_words"),
        _ngram_bins(bins).alias("_bins"),
    )
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = rows.select("_row", "_id", *base, F.explode_outer("_bins").alias("bin")).join(ratios, "bin", "left")
    scored = grams.groupBy("_row").agg(*[F.first(c).alias(c) for c in ("_id", *base)], F.round(F.coalesce(F.avg("ratio"), F.lit(0.0)), 9).alias("score"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.select(F.col("_id").alias(id_col), *base, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= threshold)).alias("kept"))
