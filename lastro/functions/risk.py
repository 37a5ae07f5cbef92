"""Risk scale expressions: bands, display score, clipping, min-max scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastro import fixed_values as fv
from lastro.functions.measures import round_even


def risk_band(value: Column, scale: float = 1.0) -> Column:
    """low / medium / high; an unknown value is treated as high.

    ``scale`` is 1 for probabilities and 100 for scores.
    """
    low, medium = fv.LOW_BELOW * scale, fv.MEDIUM_BELOW * scale
    return F.when(value < low, "low").when(value < medium, "medium").otherwise("high")


def score_outputs(probability: Column) -> list[Column]:
    """Published columns of a raw probability; the band follows the rounded probability."""
    rounded = round_even(probability, 4)
    return [
        rounded.alias("default_probability"),
        round_even(probability * 100, 1).alias("risk_score"),
        risk_band(rounded).alias("risk_category"),
    ]


def display_score(score: Column) -> Column:
    """0-100 score on the 0-1000 display scale."""
    return round_even(score * 10, 0)


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; null stays null (``greatest`` and ``least`` would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; 0 when all values are equal, when there are none, and for nulls."""
    scaled = F.when(high != low, (value - low) / (high - low))
    return F.coalesce(scaled, F.lit(0.0))
