"""Running totals and exact quantiles over a total order, without a one-task sort.

Values are first grouped, so that equal values become one row.  The grouped values of
each series are cut at approximate quantiles into buckets of similar size.  Running
totals inside a bucket come from a window per bucket, and the start of each bucket from
a window over the bucket sums (at most ``BUCKETS + 1`` rows per series).  The cuts only
decide which bucket a value falls into, so the totals are exact.

A series is a name given by the caller in a literal, so there are never more series than
measures and the per-series tables can be broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro.session import stored

BUCKETS = 256  # a power of two, for the binary search over the cuts
# Up to this many distinct values a series is ranked in one task.
ONE_TASK_ROWS = 200_000


def unpivot(
    df: DataFrame, measures: Mapping[str, Column], weights: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per non-null measure value: ``series``, ``x`` and the weight columns."""
    weights = weights or {"w": F.lit(1).cast("bigint")}
    cells = F.array(*[
        F.struct(F.lit(name).alias("series"), column.cast("double").alias("x"))
        for name, column in measures.items()
    ])
    carried = [column.alias(name) for name, column in weights.items()]
    rows = df.select(F.explode(cells).alias("_cell"), *carried).select("_cell.*", *weights)
    return rows.where(F.col("x").isNotNull())


def group_values(rows: DataFrame, weights: Sequence[str] = ("w",)) -> DataFrame:
    """One row per distinct value of a series, with summed weights."""
    return rows.groupBy("series", "x").agg(*[F.sum(w).alias(w) for w in weights])


def running_totals(
    rows: DataFrame,
    weights: Sequence[str] = ("w",),
    descending: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """One row per (``series``, ``x``) with ``cum_<w>`` (this value included) and ``all_<w>``.

    ``rows`` comes from :func:`unpivot`.  The grouped values are stored, since they are read
    more than once, and counted: few values are ranked by one window per series, many by
    buckets.
    """
    grouped = stored(group_values(rows, weights), "grouped-values")
    if grouped.count() <= one_task_rows:
        return _totals_by_series(grouped, weights, descending)
    return _totals_by_bucket(grouped, weights, descending)


def _window(partition: Sequence[str], by: str, descending: bool) -> Window:
    return Window.partitionBy(*partition).orderBy(F.col(by).desc() if descending else F.col(by).asc())


def _totals_by_series(grouped: DataFrame, weights: Sequence[str], descending: bool) -> DataFrame:
    so_far = _window(["series"], "x", descending).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("series")
    return grouped.withColumns(
        {f"cum_{w}": F.sum(w).over(so_far) for w in weights}
        | {f"all_{w}": F.sum(w).over(everything) for w in weights}
    )


def _with_bucket(df: DataFrame) -> DataFrame:
    """``_bucket``: the number of cuts below ``x``, by binary search in generated code."""
    df = df.withColumn("_bucket", F.lit(0))
    step = BUCKETS // 2
    while step:
        probe = F.get("_cuts", F.col("_bucket") + (step - 1))
        below = F.coalesce(probe < F.col("x"), F.lit(False))
        df = df.withColumn("_bucket", F.col("_bucket") + F.when(below, step).otherwise(0))
        step //= 2
    return df.drop("_cuts")


def _totals_by_bucket(grouped: DataFrame, weights: Sequence[str], descending: bool) -> DataFrame:
    shares = ", ".join(f"{i / BUCKETS}D" for i in range(1, BUCKETS))
    cuts = F.expr(f"percentile_approx(x, array({shares}), {BUCKETS * 10})")
    series = grouped.groupBy("series").agg(
        cuts.alias("_cuts"), *[F.sum(w).alias(f"all_{w}") for w in weights]
    )
    placed = _with_bucket(grouped.join(F.broadcast(series), "series"))
    earlier = _window(["series"], "_bucket", descending).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("series", "_bucket")
        .agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
        .select("series", "_bucket", *[
            F.coalesce(F.sum(f"_sum_{w}").over(earlier), F.lit(0)).alias(f"_start_{w}")
            for w in weights
        ])
    )
    within = _window(["series", "_bucket"], "x", descending).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        placed.join(F.broadcast(starts), ["series", "_bucket"])
        .withColumns({
            f"cum_{w}": F.col(f"_start_{w}") + F.sum(w).over(within) for w in weights
        })
        .drop("_bucket", *[f"_start_{w}" for w in weights])
    )


def exact_quantiles(
    df: DataFrame,
    measures: Mapping[str, Column],
    probabilities: Sequence[float],
    weight: Column | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Quantiles with linear interpolation: ``series``, ``q0``, ``q1``, ... as in ``probabilities``.

    ``weight`` is a whole number of times each row counts.  A measure without any value
    has no row in the result.
    """
    weights = {"w": (F.lit(1) if weight is None else weight).cast("bigint")}
    ranked = running_totals(unpivot(df, measures, weights), one_task_rows=one_task_rows)
    first, last = F.col("cum_w") - F.col("w"), F.col("cum_w") - 1

    picks = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("all_w") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            at_rank = F.when((rank >= first) & (rank <= last), F.col("x"))
            picks.append(F.max(at_rank).alias(f"_{side}{i}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_part{i}"))
    return ranked.groupBy("series").agg(*picks).select("series", *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(f"q{i}")
        for i in range(len(probabilities))
    ])
