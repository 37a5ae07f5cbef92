"""Exact classification metrics for any number of scores in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.operators.ranking import ONE_TASK_ROWS, running_totals, unpivot
from lastro.functions.measures import round_even


def ranking_metrics(
    df: DataFrame,
    scores: Mapping[str, Column],
    label: Column,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Area under the ROC curve (ties count half) and average precision: ``series``, ``auc_roc``, ``auc_pr``.

    Rows are grouped by score first; the totals run from the highest score down.
    """
    weights = {"pos": (label == 1).cast("bigint"), "neg": (label == 0).cast("bigint")}
    ranked = running_totals(
        unpivot(df, scores, weights), list(weights), descending=True, one_task_rows=one_task_rows
    )
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    below = F.col("all_neg") - F.col("cum_neg")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    return ranked.groupBy("series").agg(
        F.try_divide(F.sum(pos * (below + neg / 2)), pairs).alias("auc_roc"),
        F.try_divide(F.sum(pos * precision), F.max("all_pos").cast("double")).alias("auc_pr"),
    )


def confusion(df: DataFrame, predictions: Mapping[str, Column], label: Column) -> DataFrame:
    """Counts of actual by predicted label and the F1 of the positive label."""
    cells = F.array(*[
        F.struct(F.lit(n).alias("series"), p.cast("int").alias("predicted"))
        for n, p in predictions.items()
    ])
    rows = df.select(label.cast("int").alias("actual"), F.explode(cells).alias("c")).select(
        "actual", "c.*"
    )

    def count(actual: int, predicted: int) -> Column:
        return F.count_if((F.col("actual") == actual) & (F.col("predicted") == predicted))

    counted = rows.groupBy("series").agg(
        count(0, 0).alias("tn"), count(0, 1).alias("fp"),
        count(1, 0).alias("fn"), count(1, 1).alias("tp"),
    )
    hits = 2.0 * F.col("tp")
    f1 = F.coalesce(F.try_divide(hits, hits + F.col("fp") + F.col("fn")), F.lit(0.0))
    return counted.withColumn("f1", f1)


def evaluate(
    df: DataFrame,
    scores: Mapping[str, Column],
    predictions: Mapping[str, Column],
    label: Column,
) -> DataFrame:
    """One row per model: ``model``, ``auc_roc``, ``auc_pr``, ``f1``, ``confusion_matrix``.

    Both sides of the join have one row per model.
    """
    ranking = ranking_metrics(df, scores, label)
    counts = confusion(df, predictions, label)
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return counts.join(F.broadcast(ranking), "series", "left").select(
        F.col("series").alias("model"),
        *[round_even(c, 4).alias(c) for c in ("auc_roc", "auc_pr", "f1")],
        matrix.alias("confusion_matrix"),
    )
