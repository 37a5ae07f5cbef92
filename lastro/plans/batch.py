"""The batch run: raw files in, published tables out.

Stages hand over through stored Parquet tables below ``out``.  Reading a stored table
back keeps later plans short and gives a lost executor something to restart from.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lastro import contracts
from lastro.ml import models as ml
from lastro.ml import prepare
from lastro.operators import quality
from lastro.operators.joins import require_unique
from lastro.plans import cleaning, dashboard, enrichment, features, portfolio, scoring
from lastro.sources import files, sinks

log = logging.getLogger(__name__)


@dataclass
class Run:
    """Where a run writes, and the row count and width of what it wrote."""

    spark: SparkSession
    out: str
    written: dict[str, tuple[int, int]] = field(default_factory=dict)

    def _counted(self, name: str, df: DataFrame, write: Callable[[DataFrame], None]) -> None:
        """Write a dataset and note its rows, which are counted by the same job."""
        counter = Observation(name.replace("/", "_"))
        write(df.observe(counter, F.count(F.lit(1)).alias("rows")))
        self.written[name] = (counter.get["rows"], len(df.columns))
        log.info("%s: %d rows", name, counter.get["rows"])

    def store(self, name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        """Write a table as Parquet and return the stored copy."""
        path = f"{self.out}/{name}"
        self._counted(name, df, lambda d: sinks.write_parquet(d, path, partition_by))
        return self.spark.read.schema(df.schema).parquet(path)

    def export(self, name: str, df: DataFrame) -> None:
        """Write a dataset as JSON."""
        self._counted(name, df, lambda d: sinks.write_json(d, f"{self.out}/{name}"))

    def report(self) -> DataFrame:
        rows = [(n, r, c, "ok" if r else "empty") for n, (r, c) in self.written.items()]
        return self.spark.createDataFrame(rows, "dataset string, rows long, columns int, status string")


def validate_inputs(payments: DataFrame, auxiliary: DataFrame) -> DataFrame:
    return quality.validate(payments, contracts.PAYMENTS, "payments").unionByName(
        quality.validate(auxiliary, contracts.AUXILIARY, "auxiliary")
    )


def without_order(df: DataFrame) -> DataFrame:
    return df.drop(files.INGEST_ORDER)


def prepare_tables(payments: DataFrame, auxiliary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned tables with one row per key, the last one read."""
    order = F.col(files.INGEST_ORDER)
    cleaned = cleaning.deduplicate(cleaning.clean_payments(payments), "id_boleto", order)
    companies = cleaning.deduplicate(cleaning.clean_auxiliary(auxiliary), contracts.COMPANY_KEY, order)
    return without_order(cleaned), without_order(companies)


def run(
    spark: SparkSession,
    payments_path: str,
    auxiliary_path: str,
    out: str,
    as_of: Column | None = None,
    settings: ml.Settings = ml.Settings(),
    fail_on_error: bool = False,
) -> Run:
    """Load, check, clean, enrich, derive features, train, evaluate, score and publish.

    The files are parsed once into typed tables, which also fixes the position of each row.
    """
    result = Run(spark, out.rstrip("/"))
    raw_payments = result.store("raw/payments", files.load_payments(spark, payments_path, with_order=True))
    raw_auxiliary = result.store("raw/auxiliary", files.load_auxiliary(spark, auxiliary_path, with_order=True))

    report = result.store(
        "quality_report", validate_inputs(without_order(raw_payments), without_order(raw_auxiliary))
    )
    for name, raw, contract in (
        ("payments", raw_payments, contracts.PAYMENTS), ("auxiliary", raw_auxiliary, contracts.AUXILIARY),
    ):
        result.store(f"quality/unexpected_{name}", quality.unexpected_values(without_order(raw), contract))
    failed = [r["dataset"] for r in quality.summarise(report).where("NOT passed").collect()]
    if failed:
        log.warning("contract violated by %s", ", ".join(sorted(failed)))
        if fail_on_error:
            raise ValueError(f"contract violated by {', '.join(sorted(failed))}")

    payments, auxiliary = prepare_tables(raw_payments, raw_auxiliary)
    payments = result.store("clean/payments", payments)
    auxiliary = result.store("clean/auxiliary", auxiliary)
    require_unique(auxiliary, contracts.COMPANY_KEY)
    result.store("join_match_rates", enrichment.match_rates(payments, auxiliary))
    table = result.store("features/payments_features", features.build_features(payments, auxiliary, as_of))
    enriched = table.select(*payments.columns, *[
        f"{r.prefix}_{c}" for r in contracts.ROLES for c in contracts.COMPANY_ATTRIBUTES
    ])
    result.store("enriched/payments_enriched", enriched)

    importance, scored = train_and_score(result, table, settings)
    publish(result, scored, importance)
    sinks.write_parquet(result.report(), f"{result.out}/run_report")
    return result


def train_and_score(
    result: Run, table: DataFrame, settings: ml.Settings
) -> tuple[DataFrame, DataFrame]:
    """Fit the models on the train rows; returns feature importance and the scored table with its details.

    The details are scored along and stored once, so that no panel has to join the two widest tables.
    """
    out = result.out
    split = prepare.stratified_split(prepare.select_features(table))
    split = result.store("ml/split", split, "split")
    result.store("ml/split_audit", prepare.split_audit(split))
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    fitted = prepare.Preprocessor.fit(train, f"{out}/ml/preprocessor")

    trained_on = result.store("ml/train_matrix", fitted.assemble(train).select("features", contracts.TARGET))
    tested = result.store("ml/test_matrix", fitted.assemble(test).select("features", contracts.TARGET))
    for name, df in (("before_imputation", train), ("after_imputation", fitted.transform(train))):
        result.store(f"ml/audits/features_{name}", prepare.feature_audit(df))
        result.store(f"ml/audits/leakage_{name}", prepare.leakage_audit(df))
    models = ml.train_models(trained_on, settings, f"{out}/ml/models")
    metrics = result.store("ml/evaluation/metrics", ml.evaluate_models(models, tested))
    ml.metrics_json(metrics).write.mode("overwrite").text(f"{out}/ml/evaluation/model_evaluation")
    result.store("ml/evaluation/model_comparison", ml.comparison(metrics))
    importance = result.store(
        "bi/feature_importance", ml.feature_importance(result.spark, models, fitted.feature_columns)
    )
    best = ml.best_model(metrics, settings.models)
    result.store("ml/evaluation/best_model", result.spark.createDataFrame([(best,)], "model string"))
    wide = ml.score_dataset(table, models[best], fitted, dashboard.DETAIL_COLUMNS)
    return importance, result.store("detail/transactions", wide)


def publish(result: Run, scored: DataFrame, importance: DataFrame) -> None:
    """The score table, the seven portfolio tables and the dashboard datasets."""
    details = set(dashboard.DETAIL_COLUMNS) - set(contracts.SCORE_CONTEXT)
    scores = result.store("bi/boleto_scores", scored.select(*[c for c in scored.columns if c not in details]))
    tables = {
        name: result.store(f"bi/{name}", df)
        for name, df in portfolio.published_tables(scores).items()
    }
    metrics = files.read_model_metrics(
        result.spark, f"{result.out}/ml/evaluation/model_evaluation"
    )
    write_dashboard(result, dashboard.transaction_detail(scored), tables, importance, metrics)


def write_dashboard(
    result: Run,
    detail: DataFrame,
    tables: dict[str, DataFrame],
    importance: DataFrame | None = None,
    metrics: DataFrame | None = None,
) -> None:
    for name, df in dashboard.panels(detail, tables, importance, metrics).items():
        result.export(f"dashboard/{name}", df)


def build_dashboard(
    spark: SparkSession, out: str, payments_path: str, auxiliary_path: str
) -> str:
    """Dashboard from the published tables, or from the raw files when one is missing.

    Returns where the data came from.
    """
    result = Run(spark, out.rstrip("/"))
    found, complete = files.read_published(spark, f"{result.out}/bi")
    metrics = files.read_model_metrics(spark, f"{result.out}/ml/evaluation/model_evaluation")
    if complete:
        scored = files.read_optional(spark, f"{result.out}/detail/transactions")
        if scored is not None:
            detail = dashboard.transaction_detail(scored)
        else:
            table = files.read_optional(spark, f"{result.out}/features/payments_features")
            detail = dashboard.transaction_detail(found["boleto_scores"], table)
        write_dashboard(result, detail, found, found.get("feature_importance"), metrics)
        return _stored_source(result, "published tables")
    payments = files.load_payments(spark, payments_path)
    auxiliary = files.load_auxiliary(spark, auxiliary_path)
    tables = portfolio.tables_from_raw(scoring.score_by_rules(payments, auxiliary))
    detail = dashboard.with_display_columns(tables["boleto_scores"])
    write_dashboard(result, detail, tables, metrics=metrics)
    return _stored_source(result, "raw files")


def _stored_source(result: Run, source: str) -> str:
    """Where the data of a dashboard came from, kept beside it."""
    result.export("dashboard/source", result.spark.createDataFrame([(source,)], "generated_from string"))
    return source
