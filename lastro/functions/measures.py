"""Aggregate expressions whose result does not depend on how rows are partitioned.

Floating-point sums change with the order of the rows.  Money is therefore summed as
DECIMAL(18,2), and scores and probabilities, which carry one and four decimals, as
narrow decimals that Spark sums with long arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY, PROBABILITY, SCORE = "decimal(18,2)", "decimal(8,4)", "decimal(8,1)"


def total(column: Column, as_type: str = MONEY) -> Column:
    """Exact sum as a double; 0 when there is nothing to sum."""
    return F.coalesce(F.sum(column.cast(as_type)).cast("double"), F.lit(0.0))


def mean(column: Column, as_type: str = MONEY) -> Column:
    """Exact sum divided by the number of non-null values; null when there are none."""
    return F.try_divide(F.sum(column.cast(as_type)).cast("double"), F.count(column))


def share(condition: Column) -> Column:
    """Share of rows for which the condition holds; null on an empty input."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)))


def round_even(value: Column | str, digits: int) -> Column:
    """Round to the nearest, halves to the even neighbour, in double arithmetic.

    ``rint`` works on the scaled double itself, while ``bround`` rounds its decimal text; the
    two disagree on halves such as 0.575, where only ``rint`` repeats what array libraries do.
    """
    scale = float(10**digits)
    column = F.col(value) if isinstance(value, str) else value
    return F.rint(column.cast("double") * scale) / scale
