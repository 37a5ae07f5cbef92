"""Exploratory profile of a table: nulls, frequencies, descriptions, histograms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.operators.ranking import exact_quantiles, unpivot
from lastro.functions.measures import round_even


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """Null count and rate of every column, from one pass over the table."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    rows = F.count(F.lit(1)).alias("_rows")
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns
    ])
    return (
        df.agg(*counts, rows)
        .select("_rows", F.explode(cells).alias("_c"))
        .select(
            F.lit(dataset).alias("dataset"), "_c.column", "_c.nulls",
            F.try_divide(F.col("_c.nulls").cast("double"), "_rows").alias("rate"),
        )
    )


def null_counts(df: DataFrame, dataset: str) -> DataFrame:
    return null_profile(df, dataset).select("dataset", "column", "nulls").orderBy(
        F.desc("nulls"), "column"
    )


def top_null_rates(df: DataFrame, dataset: str, count: int = 5) -> DataFrame:
    return (
        null_profile(df, dataset).orderBy(F.desc("rate"), "column").limit(count)
        .select("dataset", "column", round_even("rate", 4).alias("rate"))
    )


def value_counts(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Rows per value, null being a value of its own, most frequent first."""
    counted = df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), F.asc_nulls_last(name))


_QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, measures: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """count, mean, std, min, quartiles and max of each measure, nulls skipped.

    Both inputs of the join have one row per measure.
    """
    basic = unpivot(df, measures).groupBy("series").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    quartiles = exact_quantiles(df, measures, _QUARTILES)
    joined = basic.join(F.broadcast(quartiles), "series", "left")
    shown = {"mean": "mean", "std": "std", "min": "min", "q0": "p25", "q1": "p50", "q2": "p75", "max": "max"}
    return joined.select(
        "series", "count", *[round_even(c, digits).alias(n) for c, n in shown.items()]
    )


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Equal-width bins over the value range, the maximum in the last one; empty bins included."""
    rows = df.select(value.cast("double").alias("x")).where("x IS NOT NULL")
    ends = rows.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    position = F.floor(F.try_divide((F.col("x") - ends["lo"]) * bins, ends["hi"] - ends["lo"]))
    bin_of = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = rows.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin", F.coalesce("count", F.lit(0)).alias("count")
    ).orderBy("bin")


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """Distribution of the number of rows per key."""
    frequency = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return describe(frequency, {key: F.col("n")})
