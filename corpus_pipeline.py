"""Clean a corpus: language, near copies, benchmark passages, secrets, mix.

Each stage works on what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecastops.llm import curriculum, decontamination, language_mixture, ngram_jaccard, secret_scan
from forecastops.session import lookup, small_side, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document stays if one language makes up this share of it.
MAIN_SHARE = 0.5


def _whole(docs: DataFrame) -> Column:
    """All columns of a row in one, so that no name meets one of a stage's own."""
    return F.struct(*[F.col(c) for c in docs.columns]).alias("_doc")


def _key(docs: DataFrame) -> Column:
    """(id, text hash): tells rows that repeat an id apart."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))


def one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a letter and one language for the most part. Null and empty texts go."""
    languages, model = language_mixture.learn(language_mixture.learning_rows(docs, "doc_id", "text", "lang"))
    rows = docs.select(_whole(docs), F.col("text").alias("_text"))
    found = language_mixture.identify(rows, languages, model, "_text")
    # without any labelled document no language is known, and none is rejected
    keep = (F.col("lang_pred") != "und") & (F.col("score") >= MAIN_SHARE) if languages else F.lit(True)
    return found.filter(keep).select("_doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked as near copies, the one with the smallest id; of rows that repeat an id, one.

    Rows without an id all stay, and so do documents without words under distinct ids.
    """
    groups = store(ngram_jaccard.join_groups(docs))
    ids = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("component_id") != F.col("doc_id")).alias("copy"))
    odd = lookup(ids.filter("copy or rows > 1").withColumnRenamed("doc_id", "_odd_id"))
    rows = docs.select(_whole(docs), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")).join(odd, F.col("_id") == F.col("_odd_id"), "left")
    rows = rows.filter("copy is null or not copy")
    once = F.row_number().over(Window.partitionBy("_id").orderBy("_hash"))
    repeated = rows.filter("rows > 1").withColumn("_nth", once).filter("_nth = 1").select("_doc.*")
    return rows.filter("rows is null or rows = 1").select("_doc.*").unionByName(repeated)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    matches = decontamination.find_phrases(docs, store(decontamination.windows(items)))
    hit = lookup(matches.select("doc").distinct())
    return docs.select(_whole(docs), _key(docs).alias("doc")).join(hit, "doc", "left_anti").select("_doc.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked and ``n_chars`` brought up to date where a text has changed."""
    masked = secret_scan.redacted(docs.withColumn("_before", F.xxhash64("text")))
    changed = F.xxhash64("text") != F.col("_before")
    length = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", length).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies`` and the training ``position`` of the first, sorted by position.

    Columns of these two names are replaced.
    """
    keyed = docs.select(_whole(docs), _key(docs).alias("_key"), F.col("source").alias("_source"), F.col("text").alias("_text"))
    plan = curriculum.mix(keyed, "_key", "_source", "_text").filter("passes > 0")
    taken = plan.groupBy("_key").agg(F.max("passes").alias("_copies"), F.min(F.get("positions", F.lit(0))).alias("_position"))
    given = [F.col("_doc")[c].alias(c) for c in docs.columns if c not in ("copies", "position")]
    rows = keyed.select("_key", "_doc").join(small_side(store(taken)), "_key").select(*given, F.col("_copies").alias("copies"), F.col("_position").alias("position"))
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("language", one_language),
    ("near_copies", one_of_each_group),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("mix", mixed),
]
#: SQL cannot express the language model; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that all stages keep, in training order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
