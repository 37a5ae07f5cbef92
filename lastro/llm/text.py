"""Words, letters and digests of texts, as column expressions and for Python tasks."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
BLANKS = r"[\x20\x09-\x0D]+"


def text_of(column: Column) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII texts take the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """Array of the words between ASCII white space; empty for null or blank texts."""
    bare = F.trim(text_of(text), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def split_words(text: str | None) -> list[bytes]:
    """The words of one text with A-Z in lower case; bytes.lower and bytes.split know ASCII only."""
    return (text or "").encode().lower().split()
