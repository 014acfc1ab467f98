"""Registered queries of the text operators and, where SQL can express them, the SQL that gives the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecastops.llm import archives, curriculum, decontamination, language_mixture, licences, ngram_jaccard, page_text, part_codes, periodic_runs, quality_ratio, repeated_strings, secret_scan, token_counts
from forecastops.llm.text import words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM g),
l AS (SELECT a.doc_id AS p, b.doc_id AS q FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT p, q FROM l UNION SELECT q, p FROM l),
r AS (SELECT p, q FROM both_ways UNION SELECT r.p, s.q FROM r JOIN both_ways s ON r.q = s.p),
c AS (SELECT p, min(q) AS least FROM r GROUP BY p)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id FROM g LEFT JOIN c ON c.p = g.doc_id
"""

ARCHIVE_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, n, h, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', h[i]) - 3, 4)), '') AS bits FROM p),
d AS (SELECT page_id, n, h, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6), lambda k: CAST(bits[5 * i + k] AS INTEGER) * CAST(2 ** (5 - k) AS INTEGER)))::INTEGER, 1)), '') AS digest FROM b),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM f
"""

PASSAGE_SQL = r"""
WITH b AS (SELECT item_id::VARCHAR AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(p, ' ') AS phrase, len(p) AS n FROM
        (SELECT item, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS p FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM win)),
m AS (SELECT g.doc_id, g.i, win.n, win.item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM g) g JOIN win ON win.phrase = g.phrase AND win.n = g.n),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: One branch per kind: number in order, kind, pattern, group of the value and its least length.
_SPAN_SQL = """SELECT doc_id, source, {order} AS o, '{kind}' AS kind, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    's': CAST(list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT), 'n': len(m[i]), 'v': v[i]}}), lambda x: len(x.v) >= {least})) AS x
  FROM (SELECT doc_id, source, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, string_split_regex(t, '{pattern}') AS g FROM d)"""
_SPANS = " UNION ALL ".join(_SPAN_SQL.format(order=i, kind=k, pattern=p.replace("'", "''"), group=g, least=n) for i, (k, p, g, n) in enumerate([*secret_scan.RULES, secret_scan.WIDE]))
SECRET_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, source, o, kind, x.s AS s, x.s + x.n AS e, x.v AS v FROM ({_SPANS})),
k AS (SELECT * FROM a WHERE o < 3 UNION ALL SELECT * FROM a WHERE o = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND NOT EXISTS (SELECT 1 FROM a b WHERE b.doc_id = a.doc_id AND b.o < 3 AND b.s < a.e AND a.s < b.e)),
f AS (SELECT k.*, c.owners <= {secret_scan.OWNERS} AS live, concat_ws(':', kind, s, e) AS span FROM k JOIN (SELECT v, count(DISTINCT coalesce(source, '<null>')) AS owners FROM k GROUP BY v) c ON c.v = k.v),
r AS (SELECT doc_id, count_if(o = 0) AS n_assign, count_if(o = 1) AS n_access, count_if(o = 2) AS n_hex,
      string_agg(span, ',' ORDER BY s, o) FILTER (o < 3) AS base, string_agg(span, ',' ORDER BY s, o) FILTER (o < 3 OR live) AS spans,
      count_if(live) AS n_live, count_if(NOT live) AS n_copied, string_agg(span, ',' ORDER BY s, o) FILTER (live) AS live_spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied, coalesce(live_spans, '') AS live_spans FROM d LEFT JOIN r USING (doc_id)
"""


@query("op1_ngram_jaccard", JACCARD_SQL)
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard.join_groups(table(spark, folder, "documents"))


@query("op2_archive_pages", ARCHIVE_SQL)
def op2_archive_pages(spark: SparkSession, folder: str) -> DataFrame:
    return archives.archive_pages(table(spark, folder, "pages"))


@query("op3_page_text")
def op3_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.main_text(table(spark, folder, "pages"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
t AS (SELECT source, source_size, r, least(cap, weight * (SELECT arg_min(lvl, (cap / weight, r)) FROM l WHERE lvl * weight <= cap)) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
           sum(d.size) OVER (PARTITION BY t.r ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0::DOUBLE AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (CASE WHEN middle < target THEN size ELSE 0 END + CASE WHEN middle + source_size < target THEN size ELSE 0 END)::BIGINT AS taken FROM p
"""


@query("op4_mix_sources", MIX_SQL)
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in training order of the mix; documents that it does not take stand at the end."""
    plan = curriculum.mix(table(spark, folder, "documents"))
    first = F.element_at("positions", 1)
    plan = plan.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.when(F.size("positions") > 0, first).alias("_at"))
    return plan.repartitionByRange(F.col("_at").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("_at").asc_nulls_last(), "doc_id").drop("_at")


@query("op5_licences")
def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices of all documents, by a classifier trained on the templates and on paragraphs of the documents."""
    docs = table(spark, folder, "documents")
    return licences.licences(docs, licences.train(docs))


@query("op6_language")
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents outside the held-out quarter, of which only text and language are used."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    languages, model = language_mixture.learn(language_mixture.learning_rows(docs.filter(~held_out), "doc_id", "text", "lang"))
    found = language_mixture.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), languages, model)
    mix = F.concat_ws(",", F.transform("lang_mix", lambda x: F.concat_ws(":", x["lang"], F.format_number(x["share"], 3))))
    return found.select("doc_id", "held_out", "lang_pred", "score", mix.alias("lang_mix"))


@query("op7_secrets", SECRET_SQL)
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Documents labelled as good and not toxic are the trusted ones."""
    labels = table(spark, folder, "labels")
    return quality_ratio.quality(table(spark, folder, "documents"), labels.filter("quality = 1 and toxic = 0").select("doc_id"))


@query("op10_decontamination", PASSAGE_SQL)
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


RUNS_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)) AS c FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(c, lambda r, x: list_reduce([xor(r, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) AS h FROM d),
a AS (SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS seeded, CASE WHEN n > 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS k FROM h),
p AS (SELECT doc_id, n, CASE WHEN seeded THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + k)) END]) ELSE w END AS w FROM a),
v AS (SELECT doc_id, n, w, list_transform(w, lambda x: hash(x)) AS v FROM p),
l AS (SELECT doc_id, n, v, unnest(range(1, n // 4 + 1)) AS q FROM v),
m AS (SELECT doc_id, q, list_append(list_prepend(0, list_filter(range(1, n - q + 1), lambda i: v[i] <> v[i + q])), n - q + 1) AS m FROM l),
g AS (SELECT doc_id, q, unnest(m[:-2]) AS s, unnest(m[2:]) AS e FROM m),
r AS (SELECT doc_id, s, e - s - 1 + q AS n, min(q) AS q FROM g WHERE e - s - 1 + q >= greatest(6, 4 * q) GROUP BY ALL),
f AS (SELECT doc_id, count(*) AS n_runs, list({'s': s, 'n': n, 'q': q} ORDER BY n DESC, s, q) AS l, string_agg(concat_ws(',', s, n, q) || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY doc_id)
SELECT v.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, l[1].s::BIGINT AS start, l[1].n::BIGINT AS length, l[1].q::BIGINT AS period, (1000 * l[1].n // l[1].q)::BIGINT AS exponent_milli,
       sha256(coalesce(t, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN l IS NULL THEN w ELSE list_transform(list_filter(range(v.n), lambda i: len(list_filter(l, lambda x: i >= x.s + x.q AND i < x.s + x.n)) = 0), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM v LEFT JOIN f USING (doc_id)
"""


@query("op13_periodic_runs", RUNS_SQL)
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents is made periodic from some word on, as fixed for this query; a document without id is not."""
    docs = table(spark, folder, "documents").select("doc_id", words(F.col("text")).alias("w"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, (g % n).cast("int")).alias("a")
    docs = docs.select("doc_id", "w", "h", n.alias("n"), a, (g % 8).alias("k"))
    period = F.col("n").cast("long")
    docs = docs.withColumn("p", (1 + F.floor((period - F.col("a")) / (3 + F.col("k")))).cast("int"))
    seeded = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1)) - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    text = F.array_join(F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), seeded).otherwise(F.col("w")), " ")
    found = periodic_runs.periodic_runs(docs, "doc_id", text)
    best = periodic_runs.longest(F.col("runs"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.written(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


_ROUND_SQL = """
a{r} AS MATERIALIZED (SELECT u.pos, u.x, any_value(u.n) AS n, arg_min(b.e, (list_sum(list_transform(list_zip(u.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e)) AS e,
                 min(list_sum(list_transform(list_zip(u.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS error
                 FROM u JOIN b{r} b USING (pos) GROUP BY u.pos, u.x)"""
_BOOK_SQL = """
s{r} AS (SELECT pos, e, k, (sum(n * x[k]) - ((sum(n * x[k]) % sum(n)) + sum(n)) % sum(n)) // sum(n) AS c FROM a{r}, range(1, 1 + (SELECT m FROM dims)) t(k) GROUP BY pos, e, k),
b{next} AS MATERIALIZED (SELECT b.pos, b.e, coalesce(l.c, b.c) AS c FROM b{r} b LEFT JOIN (SELECT pos, e, list(c::BIGINT ORDER BY k) AS c FROM s{r} GROUP BY pos, e) l USING (pos, e))"""
CODES_SQL = (
    """
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT max(len(v)) // 4 AS m FROM k),
p AS MATERIALIZED (SELECT vec_id, label, pos, v[pos * m + 1:pos * m + m] AS x FROM k, dims, range(4) t(pos)),
u AS MATERIALIZED (SELECT pos, x, count(*) AS n FROM p GROUP BY pos, x),
b0 AS MATERIALIZED (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256)),"""
    + ",".join(_ROUND_SQL.format(r=r) + ("," + _BOOK_SQL.format(r=r, next=r + 1) if r < 4 else "") for r in range(5))
    + """,
f AS (SELECT p.vec_id, any_value(p.label) AS label, string_agg(printf('%02x', a.e), '' ORDER BY p.pos) AS code, sum(a.error)::BIGINT AS error FROM p JOIN a4 a ON a.pos = p.pos AND a.x = p.x GROUP BY p.vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, e)) FROM b4) AS codebooks_sha256 FROM f
"""
)


@query("op11_part_codes", CODES_SQL)
def op11_part_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows, books = part_codes.compress(table(spark, folder, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


REPEATS_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d),
h AS (SELECT doc_id, i, hash(substring(x, 2 * i + 1, 200)) AS h FROM s),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM h) WHERE nth > 1),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM r),
k AS (SELECT doc_id, i, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
n AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS z FROM k GROUP BY doc_id, span),
l AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM n GROUP BY doc_id)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN l.a IS NULL THEN x ELSE array_to_string(list_transform(range(0, len(l.a) + 1),
         lambda k: substring(x, 2 * (CASE WHEN k = 0 THEN 0 ELSE l.z[k] END) + 1, 2 * (CASE WHEN k = len(l.a) THEN len(x) // 2 ELSE l.a[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE l.z[k] END))), '') END)) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id)
"""


@query("op12_repeated_strings", REPEATS_SQL)
def op12_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_strings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
