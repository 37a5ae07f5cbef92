"""The registered queries.  Each takes a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro import contracts
from lastro.catalog.views import AS_OF, Book
from lastro.contracts import AUXILIARY, BENEFICIARY, PAYER, PAYMENTS, TARGET
from lastro.functions import dates, risk, text
from lastro.ml import metrics, models, prepare
from lastro.operators import profile, quality, ranking
from lastro.operators.dedup import keep_one
from lastro.operators.joins import is_small
from lastro.plans import alerts, cleaning, dashboard, enrichment, features, portfolio, scoring
from lastro.session import scratch_path, stored
from lastro.sources import files, sinks
from lastro.functions.measures import round_even

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Callable[[Book], DataFrame]] = {}


def query(build: Callable[[Book], DataFrame]) -> Callable[[Book], DataFrame]:
    """Register a function of a :class:`Book` under its own name."""
    BUILDERS[build.__name__] = build
    QUERIES[build.__name__] = lambda spark, folder: build(Book(spark, folder))
    return build


def _as_of():
    return F.lit(AS_OF).cast("date")


# ---------------------------------------------------------------- sources

def _csv_round_trip(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _quoted(df: DataFrame, name: str) -> DataFrame:
    """The labels of a column with quotes, a comma and a line break in them."""
    return df.withColumn(name, F.concat(F.lit('a "b", '), name, F.lit('\n"')))


@query
def scan_payments(b: Book) -> DataFrame:
    return files.load_payments(b.spark, _csv_round_trip(_quoted(b.payments, "tipo_especie"), "payments"))


@query
def scan_auxiliary(b: Book) -> DataFrame:
    return files.load_auxiliary(b.spark, _csv_round_trip(_quoted(b.raw_auxiliary, "uf"), "auxiliary"))


@query
def coerce_types(b: Book) -> DataFrame:
    return files.coerce_types(
        files.null_tokens(b.text_payments),
        ("dt_emissao", "dt_vencimento", "dt_pagamento"), ("vlr_nominal", "vlr_baixa"),
    )


# ---------------------------------------------------------------- quality

@query
def dq_report(b: Book) -> DataFrame:
    report = quality.validate(b.dirty_payments, PAYMENTS, "payments").unionByName(
        quality.validate(b.dirty_auxiliary, AUXILIARY, "auxiliary")
    )
    return report.select("dataset", "check", "column", "severity", "passed", "observed", "threshold")


@query
def dq_summary(b: Book) -> DataFrame:
    return quality.summarise(
        quality.validate(b.dirty_payments, PAYMENTS, "payments").unionByName(
            quality.validate(b.raw_auxiliary, AUXILIARY, "auxiliary")
        )
    )


@query
def dq_unique(b: Book) -> DataFrame:
    lines = b.base("lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return quality.duplicate_counts(lines, lines.columns)


@query
def dq_allowed(b: Book) -> DataFrame:
    return quality.unexpected_values(b.dirty_payments, PAYMENTS).unionByName(
        quality.unexpected_values(b.dirty_auxiliary, AUXILIARY)
    )


@query
def dq_null_rate(b: Book) -> DataFrame:
    checks = quality.structural_checks(b.dirty_auxiliary, AUXILIARY)
    return checks.where(F.col("check") == "null_rate").select(
        "column", round_even("observed", 6).alias("observed"), "threshold", "passed"
    )


@query
def dq_business_rules(b: Book) -> DataFrame:
    return quality.business_rules(b.dirty_payments).select("column", "observed", "passed")


@query
def join_match_rate(b: Book) -> DataFrame:
    return enrichment.match_rates(b.dirty_payments, b.raw_auxiliary)


@query
def null_rate_top5(b: Book) -> DataFrame:
    return profile.top_null_rates(b.payments, "payments").unionByName(
        profile.top_null_rates(b.raw_auxiliary, "auxiliary")
    )


@query
def null_counts(b: Book) -> DataFrame:
    return profile.null_counts(b.payments, "payments").unionByName(
        profile.null_counts(b.raw_auxiliary, "auxiliary")
    )


# ---------------------------------------------------------------- cleaning, features

@query
def clean_payments(b: Book) -> DataFrame:
    return cleaning.clean_payments(b.dirty_payments).select(
        "id_boleto", "tipo_baixa", "tipo_especie", "settlement_code"
    )


@query
def clean_auxiliary(b: Book) -> DataFrame:
    return cleaning.clean_auxiliary(b.dirty_auxiliary).select("id_cnpj", "uf", "cd_cnae_prin")


@query
def dedup_keep_last(b: Book) -> DataFrame:
    """The last line of every order, lines being ordered by number, part and price."""
    lines = b.base("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return keep_one(lines, ["l_orderkey"], order, "last", removed=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (F.col("_copies") - 1).alias("removed"),
    )


@query
def enrich_payer(b: Book) -> DataFrame:
    return enrichment.enrich_role(b.payments, b.auxiliary, PAYER, validate=False)


@query
def enrich(b: Book) -> DataFrame:
    # Companies that are not small take the receivables twice: to count their keys and to join them.
    payments = b.payments if is_small(b.auxiliary) else b.stored_payments
    return enrichment.enrich(payments, b.auxiliary, validate=False)


@query
def temporal_features(b: Book) -> DataFrame:
    return features.add_temporal_features(b.payments, _as_of()).select(
        "id_boleto", "boleto_term_days", "payment_delay_days", "days_overdue", "is_defaulted",
        "due_month", "due_day_of_week",
    )


def _default_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("rows"), F.count("payment_delay_days").alias("paid")
    )


@query
def default_flag(b: Book) -> DataFrame:
    return _default_counts(features.add_label(b.payments))


@query
def default_flag_5d(b: Book) -> DataFrame:
    return _default_counts(features.add_label(b.payments, threshold=5))


@query
def payer_features(b: Book) -> DataFrame:
    df = features.add_temporal_features(b.payments, _as_of())
    return features.add_behaviour(df, PAYER).select(
        "id_boleto", "payer_boleto_count", "payer_default_rate", "payer_avg_nominal_value",
        "payer_avg_delay_days", "payer_max_delay_days", "payer_avg_term_days",
    )


@query
def beneficiary_features(b: Book) -> DataFrame:
    df = features.add_temporal_features(b.payments, _as_of())
    return features.add_behaviour(df, BENEFICIARY).select(
        "id_boleto", "beneficiary_boleto_count", "beneficiary_default_rate",
        "beneficiary_avg_nominal_value", "beneficiary_total_portfolio_value",
    )


@query
def payments_features(b: Book) -> DataFrame:
    """The full 47-column feature table."""
    return b.features


# ---------------------------------------------------------------- scalar functions, score

@query
def settlement_mix(b: Book) -> DataFrame:
    counted = profile.value_counts(b.payments, F.col("tipo_baixa"), "tipo_baixa")
    return counted.withColumn("meaning", text.settlement_meaning(F.col("tipo_baixa")))


@query
def cnae_division(b: Book) -> DataFrame:
    division = text.cnae_division_of_number(F.col("cd_cnae_prin"))
    return b.raw_auxiliary.select(
        "id_cnpj", division.alias("division"), text.cnae_label(division).alias("label")
    )


@query
def minmax_normalize(b: Book) -> DataFrame:
    scaled = scoring.normalise(b.raw_auxiliary, "score_materialidade_evolucao")
    return b.raw_auxiliary.select("id_cnpj", round_even(scaled, 8).alias("normalized"))


@query
def heuristic_score(b: Book) -> DataFrame:
    return b.raw_scored.select(
        "id_boleto", "is_defaulted", "risk_score", "default_probability", "risk_category"
    )


@query
def risk_category(b: Book) -> DataFrame:
    """Bands of a probability and of a score, from the delay history of the company."""
    raw = F.col("score_quantidade_v2") / 1001
    return b.raw_auxiliary.select(
        "id_cnpj", *risk.score_outputs(raw),
        risk.risk_band(F.col("score_quantidade_v2") / 10, scale=100).alias("band_of_score"),
        risk.risk_band(F.col("cedente_indice_liquidez_1m")).alias("band_with_gaps"),
    )


@query
def categorical_unknown(b: Book) -> DataFrame:
    state = text.unknown_if_null(F.col("uf")).alias("uf")
    return b.auxiliary.groupBy(state).agg(F.count(F.lit(1)).alias("companies"))


# ---------------------------------------------------------------- portfolio tables

@query
def portfolio_overview(b: Book) -> DataFrame:
    return portfolio.portfolio_overview(b.scored)


@query
def payer_risk(b: Book) -> DataFrame:
    return b.payers


@query
def beneficiary_risk(b: Book) -> DataFrame:
    return b.beneficiaries


@query
def temporal_analysis(b: Book) -> DataFrame:
    return portfolio.temporal_analysis(b.scored)


@query
def uf_analysis(b: Book) -> DataFrame:
    return portfolio.uf_analysis(b.scored)


@query
def cnae_analysis(b: Book) -> DataFrame:
    return portfolio.cnae_analysis(b.scored)


@query
def score_distribution(b: Book) -> DataFrame:
    return portfolio.score_distribution(b.scored)


@query
def entity_risk_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["payer_risk"]


@query
def segment_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["uf_analysis"]


@query
def cnae_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["cnae_analysis"]


@query
def temporal_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["temporal_analysis"]


@query
def score_distribution_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["score_distribution"]


@query
def portfolio_fallback(b: Book) -> DataFrame:
    return portfolio.tables_from_raw(b.raw_scored)["portfolio_overview"]


@query
def risk_counts(b: Book) -> DataFrame:
    return profile.value_counts(b.scored, F.col("risk_category"), "risk_category")


# ---------------------------------------------------------------- dashboard

@query
def transaction_detail(b: Book) -> DataFrame:
    """Published scores joined with the feature table."""
    detail = dashboard.transaction_detail(scoring.published_scores(b.scored), b.features)
    return detail.select(
        "id_boleto", "dt_pagamento", "vlr_baixa", "tipo_baixa", "tipo_especie",
        "payment_delay_days", "beneficiary_media_atraso_dias", "payer_media_atraso_dias",
        "due_year_month", "period_month", "entity_uf", "entity_sector", "score_display",
    )


@query
def compact_transactions(b: Book) -> DataFrame:
    return sinks.json_safe(dashboard.compact(b.detail, dashboard.TRANSACTION_COLUMNS))


@query
def export_records(b: Book) -> DataFrame:
    """The payers of the dashboard as JSON-ready records."""
    payers = b.payers.withColumn("score_display", risk.display_score(F.col("avg_risk_score")))
    return sinks.records(
        dashboard.compact(dashboard.first_payers(payers), dashboard.ENTITY_COLUMNS)
    )


SEARCH = dashboard.Filters(sector="46", search=" Alto ")


@query
def filter_transactions(b: Book) -> DataFrame:
    found = dashboard.filter_transactions(b.detail, dashboard.Filters(
        period="1998-03", uf="RJ", search="comercio"
    )).unionByName(dashboard.filter_transactions(b.detail, SEARCH))
    return found.select("id_boleto", "period_month", "entity_uf", "entity_sector", "risk_category")


def _filtered_view(b: Book) -> dict[str, DataFrame]:
    tables = {"beneficiary_risk": b.beneficiaries}
    return dashboard.view(b.detail, tables, dashboard.Filters(uf="RJ", search="comercio"))


@query
def filtered_kpis(b: Book) -> DataFrame:
    return _filtered_view(b)["kpis"]


@query
def filtered_segments(b: Book) -> DataFrame:
    return _filtered_view(b)["segments"].withColumn("liquidity", round_even("liquidity", 6))


@query
def filtered_months(b: Book) -> DataFrame:
    return _filtered_view(b)["months"]


@query
def filtered_beneficiaries(b: Book) -> DataFrame:
    found = dashboard.filter_beneficiaries(b.beneficiaries, b.detail, dashboard.Filters(
        uf="RJ", period="1998-03"
    ))
    return found.select("id_beneficiario", "uf", "cd_cnae_prin", "total_value", "avg_risk_score")


@query
def filtered_alerts(b: Book) -> DataFrame:
    """Alerts of payers with a matching receivable; the payer takes the place of the beneficiary."""
    detail = b.detail.withColumn("id_beneficiario", F.col("id_pagador"))
    found = dashboard.filter_alerts(_payer_alerts(b), detail, dashboard.Filters(
        period="1998-03", level="Critico", search="score"
    ))
    return found.select("entity_id", "uf", "alert_type", "level", "risk_score")


def _payer_alerts(b: Book) -> DataFrame:
    """Payers' scores spread wide enough to reach every kind of alert."""
    return alerts.make_alerts(b.payers, key="id_pagador")


@query
def dashboard_kpis(b: Book) -> DataFrame:
    return dashboard.kpis(b.detail)


@query
def default_rate_by_issue_month(b: Book) -> DataFrame:
    return dashboard.default_rate_by_issue_month(b.detail)


@query
def value_by_risk(b: Book) -> DataFrame:
    return dashboard.value_by_risk(b.detail)


@query
def segment_top8(b: Book) -> DataFrame:
    return dashboard.top_segments(b.detail).withColumn("liquidity", round_even("liquidity", 6))


@query
def beneficiary_delay_by_month(b: Book) -> DataFrame:
    return dashboard.delay_by_issue_month(dashboard.of_beneficiary(b.detail, "S7"))


@query
def beneficiary_drilldown(b: Book) -> DataFrame:
    return dashboard.of_beneficiary(b.detail, "S7").select(
        "id_boleto", "dt_emissao", "dt_vencimento", "dt_pagamento", "vlr_baixa", "tipo_baixa"
    )


@query
def beneficiary_first_rows(b: Book) -> DataFrame:
    return dashboard.drilldown(b.detail, "S7")


@query
def beneficiary_kpis(b: Book) -> DataFrame:
    return dashboard.beneficiary_kpis(b.detail).withColumn("liquidity", round_even("liquidity", 6))


@query
def export_sectors(b: Book) -> DataFrame:
    return sinks.json_safe(dashboard.first_sectors(portfolio.cnae_analysis(b.scored)))


@query
def aging_buckets(b: Book) -> DataFrame:
    return dashboard.aging_buckets(b.detail)


@query
def high_risk_recall(b: Book) -> DataFrame:
    return dashboard.high_risk_recall(b.detail)


@query
def facets(b: Book) -> DataFrame:
    return dashboard.facets(b.detail)


@query
def alerts_beneficiaries(b: Book) -> DataFrame:
    return b.alerts


@query
def alerts_payers(b: Book) -> DataFrame:
    return _payer_alerts(b)


@query
def alert_counts(b: Book) -> DataFrame:
    return alerts.alert_counts(_payer_alerts(b))


@query
def alert_types(b: Book) -> DataFrame:
    return alerts.alerts_by_type(_payer_alerts(b))


@query
def priority_queue(b: Book) -> DataFrame:
    return alerts.priority_queue(b.payers, "id_pagador")


# ---------------------------------------------------------------- exploration

@query
def default_rate_by_uf(b: Book) -> DataFrame:
    df = features.add_label(enrichment.enrich_role(b.payments, b.auxiliary, PAYER, validate=False), 5)
    return df.where("payer_uf IS NOT NULL").groupBy(F.col("payer_uf").alias("uf")).agg(
        round_even(F.avg(TARGET), 6).alias("default_rate")
    ).orderBy(F.desc("default_rate"), "uf")


@query
def describe_value(b: Book) -> DataFrame:
    return profile.describe(b.payments, {"vlr_nominal": F.col("vlr_nominal")})


@query
def describe_delay(b: Book) -> DataFrame:
    delay = dates.delay_days(F.col("dt_vencimento"), F.col("dt_pagamento"))
    return profile.describe(b.payments, {"dias_atraso": delay})


@query
def delay_histogram(b: Book) -> DataFrame:
    return profile.histogram(
        b.payments, dates.delay_days(F.col("dt_vencimento"), F.col("dt_pagamento"))
    )


@query
def payer_frequency(b: Book) -> DataFrame:
    return profile.rows_per_key(b.payments, "id_pagador").unionByName(
        profile.rows_per_key(b.payments, "id_beneficiario")
    )


@query
def monthly_volume(b: Book) -> DataFrame:
    month = dates.month_key(F.col("dt_vencimento")).alias("due_year_month")
    return b.payments.groupBy(month).agg(F.count(F.lit(1)).alias("count")).orderBy("due_year_month")


@query
def value_by_default_flag(b: Book) -> DataFrame:
    df = features.add_label(b.payments, threshold=5)
    return profile.describe(df, {
        name: F.when(F.col(TARGET) == value, F.col("vlr_nominal"))
        for name, value in (("false", 0), ("true", 1))
    })


@query
def top10_value(b: Book) -> DataFrame:
    return b.payments.orderBy(F.desc("vlr_nominal"), "id_boleto").limit(10).select(
        "id_boleto", "vlr_nominal"
    )


# ---------------------------------------------------------------- model preparation, metrics

def _arithmetic_split(df: DataFrame) -> DataFrame:
    key = F.substring("id_boleto", 2, 20).cast("bigint")
    return prepare.split_by(df, (key * 7919 + 42) % 1000 < 200)


@query
def ml_features(b: Book) -> DataFrame:
    return prepare.select_features(b.features)


@query
def ml_split(b: Book) -> DataFrame:
    return _arithmetic_split(features.add_label(b.payments)).select("id_boleto", TARGET, "split")


@query
def ml_audit(b: Book) -> DataFrame:
    audit = prepare.split_audit(_arithmetic_split(features.add_label(b.payments)))
    return audit.withColumns({
        "default_rate": round_even("default_rate", 6), "imbalance": round_even("imbalance", 6)
    })


@query
def feature_audit(b: Book) -> DataFrame:
    return prepare.feature_audit(prepare.select_features(b.features))


def _train(b: Book) -> DataFrame:
    split = _arithmetic_split(prepare.select_features(b.features))
    return split.where("split = 'train'")


@query
def enrich_split_keys(b: Book) -> DataFrame:
    """The joins of ``enrich`` by shuffle, with every key of more than 20 rows cut into pieces."""
    return enrichment.enrich(b.payments, b.auxiliary, small_bytes=0, min_hot_rows=20)


@query
def quantiles_bucketed(b: Book) -> DataFrame:
    """The medians of ``impute_median`` with values ranked bucket by bucket."""
    return ranking.exact_quantiles(
        _train(b), {c: F.col(c) for c in contracts.NUMERIC_FEATURES}, [0.5], one_task_rows=0
    ).withColumnRenamed("q0", "median")


@query
def impute_median(b: Book) -> DataFrame:
    return prepare.fit_medians(_train(b), contracts.NUMERIC_FEATURES).withColumnRenamed("q0", "median")


@query
def encode_ordinal(b: Book) -> DataFrame:
    return prepare.fit_categories(_train(b), contracts.CATEGORICAL_FEATURES)


@query
def class_weights(b: Book) -> DataFrame:
    return prepare.class_weights(features.add_label(b.payments))


def _rank_metrics(b: Book) -> DataFrame:
    return metrics.ranking_metrics(
        b.scored, {"rules": F.col("default_probability")}, F.col(TARGET)
    )


@query
def auc_roc(b: Book) -> DataFrame:
    return _rank_metrics(b).select("series", round_even("auc_roc", 8).alias("auc_roc"))


@query
def auc_pr(b: Book) -> DataFrame:
    return _rank_metrics(b).select("series", round_even("auc_pr", 8).alias("auc_pr"))


def _confusion(b: Book) -> DataFrame:
    called = F.col("default_probability") >= 0.5
    return metrics.confusion(b.scored, {"rules": called}, F.col(TARGET))


@query
def confusion_matrix(b: Book) -> DataFrame:
    return _confusion(b).select("series", "tn", "fp", "fn", "tp")


@query
def f1_score(b: Book) -> DataFrame:
    return _confusion(b).select("series", round_even("f1", 8).alias("f1"))


@query
def leakage_audit(b: Book) -> DataFrame:
    return prepare.leakage_audit(b.features)


@query
def stratified_split(b: Book) -> DataFrame:
    return prepare.split_audit(prepare.stratified_split(features.add_label(b.payments)))


@query
def stratified_split_rows(b: Book) -> DataFrame:
    return prepare.stratified_split(features.add_label(b.payments)).select("id_boleto", TARGET, "split")


# ---------------------------------------------------------------- trained models

# The published models in full, fitted on all train rows.  A query that meets rows and settings that were fitted before
# loads those models (``models.train_models``); anything else is fitted.
Fit = tuple


def fit_models(b: Book) -> Fit:
    """Stored feature table, fitted preprocessor, trained models and metrics on the stored test rows.

    The table keeps what models and score table read.  The split is a comparison of hashes, so each reader of its parts
    repeats it, and the inputs are not written a second time.
    """
    inputs = prepare.select_features(b.features).columns
    shown = [c for c in models.published_columns(b.features) if c not in inputs]
    table = stored(b.features.select(*inputs, *shown), "features")
    split = prepare.stratified_split(prepare.select_features(table))
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    fitted = prepare.Preprocessor.fit(train)
    matrix = stored(fitted.assemble(train).select("features", TARGET), "matrix")
    trained = models.train_models(matrix)
    return table, fitted, trained, stored(models.evaluate_models(trained, fitted.assemble(test)), "metrics")


#: A model of given coefficients, which SQL can repeat: receivables of high value and companies of low scores weigh more.
GIVEN = models.LinearModel(
    tuple(1e-6 if c == "vlr_nominal" else ((i * 7) % 11 - 5) / 5000 for i, c in enumerate(contracts.SAFE_FEATURES)), 0.1
)


@query
def score_dataset_given(b: Book) -> DataFrame:
    """All receivables scored by the given model, with medians and codes of the train rows."""
    return models.score_dataset(b.features, GIVEN, prepare.Preprocessor.fit(_train(b)))


@query
def model_overview_given(b: Book) -> DataFrame:
    """Portfolio totals of the receivables scored by the given model."""
    return portfolio.portfolio_overview(score_dataset_given(b))


@query
def model_metrics_given(b: Book) -> DataFrame:
    """Area under the curve, F1 and confusion of the given model on the test rows."""
    split = _arithmetic_split(prepare.select_features(b.features))
    fitted = prepare.Preprocessor.fit(split.where("split = 'train'").drop("split"))
    tested = models.evaluate_models({"given": GIVEN}, fitted.assemble(split.where("split = 'test'").drop("split")))
    cells = {n: F.col("confusion_matrix")[i // 2][i % 2].alias(n) for i, n in enumerate(("tn", "fp", "fn", "tp"))}
    return tested.select("model", "auc_roc", "f1", *cells.values())


@query
def model_comparison(b: Book, fit: Fit | None = None) -> DataFrame:
    return models.comparison((fit or fit_models(b))[3])


@query
def model_metrics_rank(b: Book, fit: Fit | None = None) -> DataFrame:
    """Metrics written as JSON and read back for display."""
    path = scratch_path(b.spark, "model-evaluation")
    models.metrics_json((fit or fit_models(b))[3]).write.text(path)
    return files.read_model_metrics(b.spark, path)


@query
def feature_importance(b: Book, fit: Fit | None = None) -> DataFrame:
    _, fitted, trained, _ = fit or fit_models(b)
    return models.feature_importance(b.spark, trained, fitted.feature_columns)


@query
def feature_importance_labels(b: Book, fit: Fit | None = None) -> DataFrame:
    """The model inputs by importance with their display names."""
    _, fitted, trained, _ = fit or fit_models(b)
    importance = models.feature_importance(b.spark, trained, fitted.feature_columns)
    return dashboard.top_importance(importance).withColumn("label", text.feature_label(F.col("feature")))


@query
def score_dataset(b: Book, fit: Fit | None = None) -> DataFrame:
    """All receivables scored by the best of the three models."""
    table, fitted, trained, tested = fit or fit_models(b)
    best = models.best_model(tested, models.Settings().models)
    return models.score_dataset(table, trained[best], fitted)


@query
def model_portfolio_overview(b: Book, fit: Fit | None = None) -> DataFrame:
    """Portfolio totals of the receivables scored by the best model."""
    return portfolio.portfolio_overview(score_dataset(b, fit))
