"""Default classifiers: training, evaluation, importance, scoring.

Models are fitted on all train rows.  A model is something that turns the array of model inputs into a probability and
knows the importance of each.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro import contracts
from lastro.functions.risk import score_outputs
from lastro.ml import trees
from lastro.ml.metrics import evaluate
from lastro.ml.prepare import ROW_ID, Preprocessor, class_weights
from lastro.session import shared_folder, stored

LOGISTIC, FOREST, BOOSTED = "logistic_regression", "random_forest", "gradient_boosting"
FITTED_BY = 2           # goes up with each change of what is fitted on the same rows, so that older models are not loaded
ROWS_A_TASK = 50_000    # of one iteration of the logistic regression, at least


@dataclass(frozen=True)
class Settings:
    """Model parameters; the defaults are those of the published models."""

    models: tuple[str, ...] = (LOGISTIC, FOREST, BOOSTED)
    seed: int = 42
    trees: int = 200
    forest_depth: int | None = None     # no limit: until leaves are pure
    boosting_rounds: int = 200
    boosting_depth: int = 6
    learning_rate: float = 0.1
    inverse_penalty: float = 0.1
    logistic_iterations: int = 5000
    bins: int = 256
    labelled_rows: int = 20_000     # rows of :func:`bounded`, about; the models are fitted on all rows

    def tree_plans(self) -> dict[str, trees.Plan]:
        plans = {
            FOREST: trees.Plan(self.trees, self.forest_depth, boosted=False, seed=self.seed),
            BOOSTED: trees.Plan(
                self.boosting_rounds, self.boosting_depth, boosted=True, learning_rate=self.learning_rate, seed=self.seed
            ),
        }
        return {name: plan for name, plan in plans.items() if name in self.models}


class Model(Protocol):
    def probability(self, features: Column) -> Column: ...

    def importances(self) -> np.ndarray: ...


@dataclass(frozen=True)
class LinearModel:
    """Logistic regression of given coefficients."""

    coefficients: tuple[float, ...]
    intercept: float = 0.0

    def probability(self, features: Column) -> Column:
        margin = F.lit(self.intercept)
        for i, c in enumerate(self.coefficients):
            margin = margin + F.get(features, F.lit(i)) * F.lit(c)
        return 1 / (1 + F.exp(-margin))

    def importances(self) -> np.ndarray:
        return np.abs(np.array(self.coefficients))


def bounded(train: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All rows, or about ``labelled_rows`` of them, picked by a hash of their id, for trials on a part of a table.

    No query and no batch run uses it: published models are fitted on all rows.
    """
    share = settings.labelled_rows / max(train.count(), 1)
    if share >= 1:
        return train
    hashed = F.shiftrightunsigned(F.xxhash64(F.col(ROW_ID), F.lit(settings.seed)), 1)
    return train.where(hashed < F.lit(int(share * float(1 << 63))))


def with_weights(train: DataFrame) -> DataFrame:
    """Balanced weights, and the weights that only lift the positive label."""
    weights = class_weights(train).agg(F.struct(
        F.max(F.when(F.col("label") == 0, F.col("balanced_weight"))).alias("negative"),
        F.max(F.when(F.col("label") == 1, F.col("balanced_weight"))).alias("positive"),
        F.max("negative_to_positive").alias("ratio"),
    )).scalar()
    positive = F.col(contracts.TARGET) == 1
    return train.withColumns({
        "balanced_weight": F.when(positive, weights["positive"]).otherwise(weights["negative"]),
        "positive_weight": F.when(positive, weights["ratio"]).otherwise(F.lit(1.0)),
    })


def fingerprint(train: DataFrame, settings: Settings) -> str:
    """A name for what a fit depends on: the rows, whatever their order, and the settings."""
    content = F.xxhash64(vector_to_array("features"), contracts.TARGET).cast("decimal(38,0)")
    rows, total = train.agg(F.count("*"), F.sum(content)).first()
    return hashlib.sha256(f"{rows} {total} {settings!r} {trees.LAYOUT} {FITTED_BY}".encode()).hexdigest()


def _read_text(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException:
        return None


def load_models(spark: SparkSession, path: str, settings: Settings = Settings()) -> dict[str, Model]:
    """The models below a folder, in the order of the settings."""
    found: dict[str, Model] = {}
    linear = LogisticRegressionModel.load(f"{path}/{LOGISTIC}") if LOGISTIC in settings.models else None
    plans = settings.tree_plans()
    cuts = [np.array(c, float) for c in json.loads(spark.read.text(f"{path}/cuts").first()["value"])]
    grown = spark.read.schema(trees.LAYOUT).parquet(f"{path}/trees")
    for name in settings.models:
        own = grown.where(F.col("model") == name)
        if name == LOGISTIC:
            found[name] = LinearModel(tuple(map(float, linear.coefficients)), float(linear.intercept))
        elif plans[name].boosted:
            # As many trees as the settings say, of a depth that they bound.
            found[name] = trees.Ensemble.of(own.toArrow(), len(cuts), True)
        else:
            # One row of sums for each tree; the trees themselves are read where they are walked.
            gains = own.where("start = 0").orderBy("tree").select("gains").toArrow()["gains"].combine_chunks().flatten()
            gains = gains.to_numpy().reshape(-1, len(cuts))
            found[name] = trees.Forest(f"{path}/trees", name, len(gains), cuts, gains.sum(axis=0))
    return found


def train_models(train: DataFrame, settings: Settings = Settings(), path: str | None = None) -> dict[str, Model]:
    """Fit each classifier on assembled rows from a stored table, or load what was fitted on the same rows before.

    All rows are fitted on, see :mod:`trees` for how.  Models lie below ``path`` with the fingerprint of their rows and settings,
    written last; where it is the same, nothing is fitted, and otherwise the models are replaced.  Without a path it is
    a folder of this name in the shared folder, so that runs on the same input share a fit and others do not.
    """
    spark = train.sparkSession
    mark = fingerprint(train, settings)
    path = path or f"{shared_folder(spark)}/models-{mark[:32]}"
    if _read_text(spark, f"{path}/fingerprint") == mark:
        return load_models(spark, path, settings)
    weighted = stored(with_weights(train).select("features", contracts.TARGET, "balanced_weight", "positive_weight"), "weighted")
    rows = weighted.count()
    if LOGISTIC in settings.models:
        # Balanced weights add up to the number of rows, so the mean loss that Spark minimises needs the penalty
        # 1 / (C * rows).
        LogisticRegression(
            featuresCol="features", labelCol=contracts.TARGET, weightCol="balanced_weight",
            regParam=1.0 / (settings.inverse_penalty * max(rows, 1)), elasticNetParam=0.0, standardization=False,
            maxIter=settings.logistic_iterations,
        ).fit(weighted.coalesce(1 + rows // ROWS_A_TASK)).write().overwrite().save(f"{path}/{LOGISTIC}")
    plans = settings.tree_plans()
    weights = {name: "positive_weight" if plan.boosted else "balanced_weight" for name, plan in plans.items()}
    given = trees.inputs(weighted.withColumn("features", vector_to_array("features")), contracts.TARGET, weights, settings.bins)
    trees.fit(spark, given, plans=plans).write.mode("overwrite").parquet(f"{path}/trees")
    for name, value in (("cuts", json.dumps([c.tolist() for c in given.cuts])), ("fingerprint", mark)):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
    return load_models(spark, path, settings)


def predict(models: dict[str, Model], assembled: DataFrame, *keep: str) -> DataFrame:
    """Probability and predicted label of every model side by side."""
    inputs = vector_to_array(F.col("features"))
    scored = assembled.select(
        *keep, contracts.TARGET, *[m.probability(inputs).alias(f"score_{n}") for n, m in models.items()]
    )
    return scored.withColumns({f"predicted_{n}": (F.col(f"score_{n}") > 0.5).cast("int") for n in models})


def evaluate_models(models: dict[str, Model], assembled_test: DataFrame) -> DataFrame:
    """Metrics of all models on the test rows; the predictions are computed once and stored."""
    predicted = stored(predict(models, assembled_test), "predictions")
    return evaluate(
        predicted,
        {n: F.col(f"score_{n}") for n in models},
        {n: F.col(f"predicted_{n}") for n in models},
        F.col(contracts.TARGET),
    )


def metrics_json(metrics: DataFrame) -> DataFrame:
    """All metrics as one JSON text; there is one row per model to begin with."""
    entry = F.struct("auc_roc", "auc_pr", "f1", "confusion_matrix")
    entries = F.sort_array(F.collect_list(F.struct("model", entry)))
    return metrics.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def comparison(metrics: DataFrame) -> DataFrame:
    return metrics.select("model", "auc_roc", "auc_pr", "f1")


def best_model(metrics: DataFrame, order: tuple[str, ...]) -> str:
    """Highest AUC; the model trained first wins a tie."""
    aucs = {r["model"]: r["auc_roc"] for r in metrics.select("model", "auc_roc").collect()}
    return max((n for n in order if n in aucs), key=lambda n: aucs[n] or 0.0)


def feature_importance(
    spark: SparkSession, models: dict[str, Model], features: Sequence[str]
) -> DataFrame:
    """Importance of each feature in each model; absolute coefficients for a linear model."""
    rows = []
    for name, model in models.items():
        rows += [(name, f, float(v)) for f, v in zip(features, model.importances())]
    schema = "model string, feature string, importance double"
    return spark.createDataFrame(rows, schema).orderBy("model", F.desc("importance"), "feature")


def published_columns(features: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """Columns of the feature table that the score table shows."""
    kept = [
        c for c in (
            *contracts.IDENTIFIERS, *contracts.DATES, contracts.TARGET, *contracts.SCORE_CONTEXT
        ) if c in features.columns
    ]
    return kept + [c for c in extra if c in features.columns and c not in kept]


def score_dataset(
    features: DataFrame, model: Model, preprocessor: Preprocessor, extra: Sequence[str] = ()
) -> DataFrame:
    """The published score table of all receivables, train rows included, with the columns of ``extra`` that exist.

    The published columns travel along under other names, since the preprocessor replaces
    the model inputs in place; this saves a join of the table with itself.
    """
    carried = F.struct(*published_columns(features, extra)).alias("_kept")
    inputs = features.select(ROW_ID, *preprocessor.feature_columns, carried)
    assembled = preprocessor.transform(inputs)
    values = F.array(*preprocessor.feature_columns)
    scored = assembled.select("_kept", model.probability(values).alias("_probability"))
    return scored.select("_kept.*", *score_outputs(F.col("_probability")))
