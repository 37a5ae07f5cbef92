"""Text expressions: trimming, codes, sector divisions, compact ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastro import fixed_values as fv
from lastro.functions.literals import lookup


def strip(column: Column) -> Column:
    """Remove all leading and trailing whitespace, not only blanks."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def leading_code(column: Column) -> Column:
    """Digits at the start of a label as text; null when there are none."""
    return F.nullif(F.regexp_extract(column, r"^(\d+)", 1), F.lit(""))


def settlement_code(label: Column) -> Column:
    return leading_code(label).try_cast("bigint")


def settlement_meaning(label: Column) -> Column:
    return lookup(leading_code(label), fv.SETTLEMENT_MEANING)


def unknown_if_null(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("UNKNOWN"))


def cnae_division(code: Column) -> Column:
    """First two digits of the seven-digit sector code.

    Numbers are written as whole numbers first, since a double such as 6201501.0
    would otherwise print in scientific notation.
    """
    whole = F.substring_index(code.cast("string"), ".", 1)
    digits = F.nullif(F.regexp_replace(whole, r"\D", ""), F.lit(""))
    padded = F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits)
    return F.substring(padded, 1, 2)


def cnae_division_of_number(code: Column) -> Column:
    return cnae_division(code.cast("bigint"))


def cnae_label(division: Column) -> Column:
    """Readable sector name.  The lookup has 87 fixed entries, so it is a literal map."""
    name = F.coalesce(lookup(division, fv.CNAE_DIVISIONS), F.lit(fv.CNAE_DEFAULT_NAME))
    return F.concat(name, F.lit(" (CNAE "), division, F.lit(")"))


def compact_id(column: Column) -> Column:
    return F.substring(column.cast("string"), 1, 12)


def feature_label(name: Column) -> Column:
    """Display name of a model input: the fixed name, or one derived from the column name."""
    derived = name
    for prefix, shown in fv.FEATURE_PREFIX_DISPLAY.items():
        derived = F.regexp_replace(derived, f"^{prefix}", shown)
    derived = F.initcap(F.regexp_replace(derived, "_", " "))
    return F.coalesce(lookup(name, fv.FEATURE_DISPLAY), derived)
