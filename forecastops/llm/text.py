"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters keep their case."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")
