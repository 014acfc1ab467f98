"""Secrets in documents, told apart by who owns a value across the corpus.

A fixed set of rules finds assignments, access keys and hexadecimal strings; a wider rule finds other key-like strings. The
values' digests are counted by distinct documents and distinct owners: a value that many owners share is a copied example,
one that few hold looks live. Live-looking values of the wider rule are added to the found spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.session import small_side, store

#: Kinds in their order, with pattern, group that holds the value and least length of that value.
RULES: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: The wider rule: a long unbroken run that mixes letters and digits.
WIDE = ("key", r"[A-Za-z0-9+/_-]{20,}", 0, 20)
#: A value that more owners than this hold is a copied example.
OWNERS = 3


def _spans(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches, in code points, with the digest of the value.

    The gaps between matches are what a split at the pattern leaves, so a match begins where the gaps and matches before
    it end.
    """

    def placed(gaps: Column, found: Column, values: Column) -> Column:
        def step(so_far: Column, m: Column) -> Column:
            start = so_far["at"] + F.length(m["gap"])
            end = start + F.length(m["whole"])
            span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"), F.sha2(m["value"].cast("binary"), 256).alias("digest"))
            kept = F.when(F.length(m["value"]) >= least, F.concat(so_far["spans"], F.array(span))).otherwise(so_far["spans"])
            return F.struct(end.alias("at"), kept.alias("spans"))

        empty = F.from_json(F.lit("[]"), "array<struct<start:int,order:int,end:int,kind:string,digest:string>>")
        matches = F.zip_with(F.slice(gaps, 1, F.size(found)), F.arrays_zip(found.alias("whole"), values.alias("value")), lambda g, m: F.struct(g.alias("gap"), m["whole"].alias("whole"), m["value"].alias("value")))
        return F.aggregate(matches, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda x: x["spans"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.when(text.rlike(pattern), placed(F.split(text, pattern, -1), found, values))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """Per row: _row, id, owner, base (spans of the fixed rules by start, then kind) and wide (spans of the wider rule).

    Spans of the wider rule mix letters and digits and touch no base span. A null text has none.
    """
    none = F.from_json(F.lit("[]"), "array<struct<start:int,order:int,end:int,kind:string,digest:string>>")
    text = F.col("_text")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = F.array_sort(F.concat(*[F.coalesce(_spans(text, i, *rule), none) for i, rule in enumerate(RULES)]))
    rows = rows.withColumn("base", base).withColumn("wide", F.coalesce(_spans(text, len(RULES), *WIDE), none))

    def apart(s: Column) -> Column:
        value = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        touches = F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~touches

    return rows.withColumn("wide", F.filter("wide", apart)).drop("_text")


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, n_docs, n_owners): distinct documents and owners of each value. ``candidates`` has digest, id and owner.

    Values are counted down in steps, each combined on the map side, so a value that fills the corpus is spread over tasks.
    """
    by_doc = candidates.groupBy("digest", "owner", "id").agg(F.lit(1).alias("one"))
    by_owner = by_doc.groupBy("digest", "owner").agg(F.count("*").alias("docs"))
    return by_owner.groupBy("digest").agg(F.sum("docs").alias("n_docs"), F.count("*").alias("n_owners"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", max_owners: int = OWNERS) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, live_spans.

    ``base_sha256`` digests the base spans as kind:start:end by start, then kind; ``spans`` lists them with the live-looking
    ones of the wider rule. ``n_live`` and ``n_copied`` count all found values by whether at most ``max_owners`` owners hold
    them; ``live_spans`` lists the live ones. Null and empty texts have no spans, repeated rows stand for themselves, a null
    owner is an owner, and an empty table gives no rows. Texts are scanned once and are not shuffled.
    """
    found = store(find_spans(docs, id_col, text_col, owner_col))
    every = found.filter((F.size("base") > 0) | (F.size("wide") > 0)).select("_row", "id", "owner", F.explode(F.concat("base", "wide")).alias("s"))
    every = every.select("_row", "id", "owner", "s.*")
    owned = every.select("_row", "start", "order", "end", "kind", "digest").join(ownership(every), "digest")
    live = F.col("n_owners") <= max_owners
    span = F.struct("start", "order", "end", "kind")
    per_doc = owned.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.when((F.col("order") < len(RULES)) | live, span))).alias("spans"),
        F.array_sort(F.collect_list(F.when(live, span))).alias("live"),
        F.count_if(~live).alias("n_copied"),
    )
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of_kind(kind) for kind, *_ in RULES]
    return found.join(per_doc, "_row", "left").select(
        F.col("id").alias(id_col), *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col("spans")), F.lit("")).alias("spans"),
        F.coalesce(F.size("live"), F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce(_listed(F.col("live")), F.lit("")).alias("live_spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", max_owners: int = OWNERS, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each live-looking span replaced by ``mark``; all columns and rows stay.

    Rows meet their spans by id and text hash, so rows that repeat an id are told apart.
    """
    names = docs.columns
    text, owner = F.col("_doc")[text_col], F.col("_doc")[owner_col]
    keyed = docs.select(F.struct(*[F.col(c) for c in names]).alias("_doc")).withColumn("_key", F.struct(F.col("_doc")[id_col].alias("id"), F.xxhash64(text).alias("text")))
    found = find_spans(keyed.select("_key", text.alias("_text"), owner.alias("_owner")), "_key", "_text", "_owner")
    every = store(found.select("id", "owner", F.explode(F.concat("base", "wide")).alias("s")).select("id", "owner", "s.*"))
    live = every.join(ownership(every), "digest").filter(F.col("n_owners") <= max_owners)
    per_doc = live.groupBy(F.col("id").alias("_key")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_live"))

    def step(so_far: Column, s: Column) -> Column:
        piece = F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"])
        more = F.when(s["start"] >= so_far["at"], F.concat(so_far["out"], piece, F.lit(mark))).otherwise(so_far["out"])
        return F.struct(F.greatest(s["end"], so_far["at"]).alias("at"), more.alias("out"))

    rest = lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text)))
    done = F.aggregate("_live", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    new_text = F.when(F.col("_live").isNull(), text).otherwise(done)
    return keyed.join(small_side(store(per_doc)), "_key", "left").select(*[new_text.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in names])
