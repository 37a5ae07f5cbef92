"""Literal collections written as SQL text.

One expression text is parsed at once, where building the same literal from hundreds of
Python column objects would take as many calls into the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted SQL column name."""
    return "`" + column.replace("`", "``") + "`"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of a small fixed table; null for an unknown key."""
    pairs = ", ".join(quoted(x) for pair in table.items() for x in pair)
    return F.try_element_at(F.expr(f"map({pairs})"), key)
