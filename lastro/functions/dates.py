"""Date expressions: terms, delays, the default label, month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastro import fixed_values as fv


def term_days(issued: Column, due: Column) -> Column:
    return F.datediff(due, issued)


def delay_days(due: Column, paid: Column) -> Column:
    """Days past the due date; negative when early, null while unpaid."""
    return F.datediff(paid, due)


def days_overdue(due: Column, paid: Column, as_of: Column | None = None) -> Column:
    today = F.current_date() if as_of is None else as_of
    return F.when(paid.isNull(), F.datediff(today, due)).otherwise(F.lit(0))


def default_flag(
    paid: Column, delay: Column, threshold: int = fv.DEFAULT_THRESHOLD_DAYS
) -> Column:
    """1 when unpaid or paid later than the threshold; a paid row without a delay counts as 0."""
    late = F.coalesce(delay > F.lit(threshold), F.lit(False))
    return (paid.isNull() | late).cast("int")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")

