"""Many-to-one joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.operators.dedup import repeated_keys
from lastro.session import stored

# A dimension is broadcast only when Catalyst estimates it below this size.
SMALL_BYTES = 10 * 1024 * 1024
# A key is hot when it holds more than 1/HOT_KEYS of all rows, so by counting there are
# fewer than HOT_KEYS hot keys and their list can always be broadcast.
HOT_KEYS = 10_000
# Keys below this size fit one task and are never split.
MIN_HOT_ROWS = 1_000_000


def require_unique(dim: DataFrame, key: str) -> None:
    """Fail when the right side of a many-to-one join repeats a key."""
    if repeated_keys(dim.select(key), [key]).limit(1).count():
        raise ValueError(f"many-to-one join needs unique values in {key}")


def is_small(dim: DataFrame, small_bytes: int = SMALL_BYTES) -> bool:
    """True when Catalyst's size estimate, as ``EXPLAIN COST`` prints it for the whole plan, is small."""
    plan = dim.sparkSession.sql("EXPLAIN COST SELECT * FROM {dim}", dim=dim).first()[0]
    estimate = re.search(r"sizeInBytes=([0-9.E+]+) (\w+)", plan)
    scale = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40, "PiB": 1 << 50, "EiB": 1 << 60}
    return bool(estimate) and float(estimate[1]) * scale[estimate[2]] <= small_bytes


def key_counts(fact: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """Rows of each value of several keys, counted in one pass over those columns and stored."""
    cells = F.array(*[F.struct(F.lit(k).alias("_key"), F.col(k).cast("string").alias("_value")) for k in keys])
    counted = fact.select(F.explode(cells).alias("c")).select("c.*").groupBy("_key", "_value").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    counted = stored(counted, "key-counts")
    kinds = {f.name: f.dataType for f in fact.schema.fields}
    return {
        k: counted.where(F.col("_key") == k).select(F.col("_value").cast(kinds[k]).alias(k), "_rows") for k in keys
    }


def hot_keys(counts: DataFrame, key: str, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Hot keys and the number of pieces each is cut into, fewer than ``2 * HOT_KEYS`` in all."""
    total = counts.agg(F.sum("_rows")).scalar()
    piece = F.greatest(total / F.lit(HOT_KEYS), F.lit(float(min_hot_rows)))
    pieces = F.ceil(F.col("_rows") / piece).cast("int")
    return counts.where(F.col("_rows") > piece).select(key, pieces.alias("_pieces"))


def left_join_many_to_one(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    row_id: str,
    counts: DataFrame | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """``fact LEFT JOIN dim`` on the equally named ``key``, which is unique in ``dim``.

    A dimension of checked small size is broadcast.  Otherwise both sides are shuffled:
    rows of a hot key are spread over several pieces by a hash of ``row_id`` (a retried
    task computes the same piece again), and the one matching dimension row is repeated
    once per piece.  ``counts`` (``key``, ``_rows``) may be passed when the caller has
    already counted the keys.
    """
    if is_small(dim, small_bytes):
        return fact.join(F.broadcast(dim), key, "left")
    if counts is None:
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(hot_keys(counts, key, min_hot_rows))
    # A null key has no partner, so its rows may go anywhere.
    pieces = F.when(F.col(key).isNull(), HOT_KEYS).otherwise(F.coalesce("_pieces", F.lit(1)))
    left = fact.join(hot, key, "left").withColumn(
        "_piece", F.pmod(F.xxhash64(row_id), pieces).cast("int")
    ).drop("_pieces")
    right = dim.join(hot, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    ).drop("_pieces")
    return left.join(right, [key, "_piece"], "left").drop("_piece")
