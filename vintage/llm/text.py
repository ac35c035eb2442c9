"""Word and line expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")
