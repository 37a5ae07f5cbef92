"""Keep one row per key.

Only keys and orders are aggregated, with map-side combining, so a key with a third of all rows reaches its
reducer as one row per map task.  The repeated keys, usually few, are joined to the full rows, of which all but one
per key go.  While their table is small enough for Spark to broadcast, full rows are neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.session import stored


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Column,
    keep: str | bool = "last",
    removed: bool = False,
) -> DataFrame:
    """Keep the last (or first) row in ``order`` per key; ``keep=False`` drops every repeated key.

    Null keys are equal to each other.  ``order`` has to be unique within a key.
    ``removed=True`` adds ``_copies``, the number of input rows of the key.
    """
    best = (F.min if keep == "first" else F.max)("_order")
    narrow = df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], order.alias("_order"))
    many = narrow.groupBy(*[f"_key{i}" for i in range(len(keys))]).agg(
        best.alias("_best"), F.count(F.lit(1)).alias("_copies")
    )
    many = stored(many.where("_copies > 1"), "repeated-keys")
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    joined = df.withColumn("_order", order).join(many, reduce(lambda a, b: a & b, same), "left")
    stays = F.col("_copies").isNull()
    if keep is not False:
        stays |= F.col("_order") == F.col("_best")
    copies = [F.coalesce("_copies", F.lit(1)).cast("long").alias("_copies")] if removed else []
    return joined.where(stays).select(*df.columns, *copies)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")
