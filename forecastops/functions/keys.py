"""Identifiers, semi-structured key bags and routing buckets, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "∅"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_id(*parts: str | Column) -> Column:
    """SHA-256 over the parts joined by ``||``; an absent part counts as a fixed mark, so ids are never null."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(ABSENT)) for p in parts]
    return F.sha2(F.concat_ws("||", *texts), 256)


def entity_map(entries: Mapping[str, str | Column]) -> Column:
    """String-to-string key bag of a landing row."""
    pairs: list[Column] = []
    for key, value in entries.items():
        pairs += [F.lit(key), _col(value).cast("string")]
    return F.create_map(*pairs)


def entity_key(column: str | Column, key: str, kind: str = "string") -> Column:
    """Typed read of one key of a key bag, so that joins hash a typed column instead of a map lookup."""
    return _col(column)[key].cast(kind)


def stable_bucket(buckets: int, *ids: str | Column) -> Column:
    """Bucket 0..buckets-1 of a key, the same in every run and on every engine that has MD5."""
    text = F.concat_ws("|", *[F.coalesce(_col(i).cast("string"), F.lit(ABSENT)) for i in ids])
    leading = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(leading, F.lit(buckets)).cast("int")


def model_uri_part(uri: str | Column, part: str) -> Column:
    """``name`` or ``version`` of an address of the form ``models:/<name>/<version>``."""
    position = {"name": 1, "version": 2}[part]
    return F.regexp_extract(_col(uri), r"^models:/([^/]+)/(.+)$", position)


def first_number(text: str | Column) -> Column:
    """First run of digits in a text as an integer; null where there is none."""
    return F.expr("try_cast(regexp_substr({0}, '[0-9]+') AS INT)".format(_name(text)))


def _name(c: str | Column) -> str:
    if not isinstance(c, str):
        raise TypeError("pass a column name")
    return f"`{c}`"


def number_or_zero(c: str | Column) -> Column:
    """Numeric value of a text, 0 where it is no number."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))
