"""Drill-down tables over the scored receivables.

``Filters`` is the state of an interactive view; it becomes one Catalyst predicate, so
that a Parquet scan can use it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro import contracts
from lastro import fixed_values as fv
from lastro.functions import dates, risk, text
from lastro.functions.literals import lookup
from lastro.functions.measures import SCORE, total
from lastro.plans import alerts as alerting

MONTHS_SHOWN, SEGMENTS_SHOWN = 12, 8


@dataclass(frozen=True)
class Filters:
    """Selected values; None leaves a dimension open."""

    period: str | None = None
    uf: str | None = None
    sector: str | None = None
    risk: str | None = None
    level: str | None = None
    search: str = ""


# What the detail shows besides the columns of the score table.
DETAIL_COLUMNS = (
    "dt_pagamento", "vlr_baixa", "tipo_baixa", "tipo_especie", "payment_delay_days",
    "beneficiary_media_atraso_dias", "beneficiary_cedente_indice_liquidez_1m",
    "beneficiary_sacado_indice_liquidez_1m", "beneficiary_indicador_liquidez_quantitativo_3m",
    "beneficiary_share_vl_inad_pag_bol_6_a_15d", "payer_media_atraso_dias",
    "payer_sacado_indice_liquidez_1m",
)


def transaction_detail(scores: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Scored receivables with settlement details and display columns.

    The details come with the scores (``score_dataset(extra=DETAIL_COLUMNS)``) or, where these were left out, from the
    feature table by a join of the two.
    """
    detail = scores
    if features is not None:
        wanted = [c for c in DETAIL_COLUMNS if c in features.columns and c not in scores.columns]
        if wanted:
            detail = scores.join(features.select("id_boleto", *wanted), "id_boleto", "left")
    return with_display_columns(detail)


def with_display_columns(detail: DataFrame) -> DataFrame:
    """Month keys, state and sector of the entity shown, and the display score."""
    return detail.withColumns({
        "due_year_month": dates.month_key(F.col("dt_vencimento")),
        "period_month": dates.month_key(F.col("dt_emissao")),
        "entity_uf": F.coalesce("beneficiary_uf", "payer_uf"),
        "entity_sector": F.coalesce("beneficiary_cd_cnae_prin", "payer_cd_cnae_prin"),
        "score_display": risk.display_score(F.col("risk_score")),
    })


# The columns handed to the presentation layer, in order.
TRANSACTION_COLUMNS = (
    "id_pagador", "id_beneficiario", "dt_emissao", "dt_vencimento", "dt_pagamento",
    "vlr_nominal", "vlr_baixa", "tipo_baixa", "is_defaulted", "payer_uf", "beneficiary_uf",
    "payer_cd_cnae_prin", "beneficiary_cd_cnae_prin", "payment_delay_days",
    "beneficiary_media_atraso_dias", "beneficiary_cedente_indice_liquidez_1m",
    "beneficiary_share_vl_inad_pag_bol_6_a_15d", "default_probability", "risk_score",
    "risk_category", "period_month", "due_year_month", "entity_uf", "entity_sector",
    "score_display",
)
ENTITY_COLUMNS = (
    "id_beneficiario", "id_pagador", "total_boletos", "total_value", "avg_boleto_value",
    "defaulted_boletos", "default_rate", "avg_default_probability", "avg_risk_score",
    "max_risk_score", "uf", "cd_cnae_prin", "risk_category", "score_display",
)
ALERT_COLUMNS = (
    "entity_type", "entity_id", "uf", "sector", "risk_category", "risk_score", "score_display",
    "default_rate", "total_value", "alert_type", "level", "status", "description",
)
COMPACT_IDS = ("id_pagador", "id_beneficiario", "entity_id")
SETTLEMENT_TEXT_LENGTH = 54


def compact(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The listed columns that exist; ids and settlement labels get a short form beside them for display."""
    kept = []
    for name in (c for c in columns if c in df.columns):
        kept.append(F.col(name))
        if name in COMPACT_IDS:
            kept.append(text.compact_id(F.col(name)).alias(f"{name}_short"))
        elif name == "tipo_baixa":
            short = F.substring(F.coalesce(F.col(name), F.lit("")), 1, SETTLEMENT_TEXT_LENGTH)
            kept.append(short.alias(f"{name}_short"))
    return df.select(kept)


def division(code: Column) -> Column:
    return text.cnae_division_of_number(code)


def sector_display(code: Column) -> Column:
    """Sector name of a code; without a code the default name and a dash."""
    return F.coalesce(text.cnae_label(division(code)), F.lit(f"{fv.CNAE_DEFAULT_NAME} -"))


def _risk_display(band: Column) -> Column:
    return lookup(band, fv.RISK_DISPLAY)


def _search_text(*columns: Column) -> Column:
    """Lower-case text of all columns joined by blanks; a missing one leaves its blank."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _searched(filters: Filters, *columns: Column) -> list[Column]:
    wanted = filters.search.lower().strip()
    return [F.contains(_search_text(*columns), F.lit(wanted))] if wanted else []


def transaction_filter(filters: Filters, include_search: bool = True) -> Column:
    sectors = ("entity_sector", "beneficiary_cd_cnae_prin", "payer_cd_cnae_prin")
    states = ("entity_uf", "beneficiary_uf", "payer_uf")
    conditions = []
    if filters.period:
        # A date range instead of a comparison of month texts: it reaches the Parquet scan.
        first = F.to_date(F.lit(f"{filters.period}-01"))
        issued = F.col("dt_emissao")
        conditions.append((issued >= first) & (issued < F.add_months(first, 1)))
    if filters.uf:
        conditions.append(_any_of([F.col(c) == filters.uf for c in states]))
    if filters.sector:
        conditions.append(_any_of([
            F.coalesce(division(F.col(c)), F.lit("-")) == filters.sector for c in sectors
        ]))
    if filters.risk:
        conditions.append(F.col("risk_category") == filters.risk)
    if include_search:
        conditions += _searched(
            filters, F.col("id_beneficiario"), F.col("id_pagador"),
            *[F.col(c) for c in states], F.col("entity_sector").cast("bigint"),
            sector_display(F.col("entity_sector")), _risk_display(F.col("risk_category")),
        )
    return _all_of(conditions)


def filter_transactions(
    detail: DataFrame, filters: Filters, include_search: bool = True
) -> DataFrame:
    return detail.where(transaction_filter(filters, include_search))


def _visible_beneficiaries(detail: DataFrame, filters: Filters) -> DataFrame:
    """Full ids, once each, of the beneficiaries with a matching receivable."""
    visible = filter_transactions(detail, filters, include_search=False)
    return visible.select("id_beneficiario").where("id_beneficiario IS NOT NULL").distinct()


def filter_beneficiaries(
    beneficiaries: DataFrame, detail: DataFrame, filters: Filters
) -> DataFrame:
    conditions = _searched(
        filters, F.col("id_beneficiario"), F.col("cd_cnae_prin").cast("bigint"),
        F.col("uf"), sector_display(F.col("cd_cnae_prin")), _risk_display(F.col("risk_category")),
    )
    conditions += _entity_conditions(filters, "cd_cnae_prin")
    kept = beneficiaries.where(_all_of(conditions))
    return kept.join(_visible_beneficiaries(detail, filters), "id_beneficiario", "left_semi").orderBy(
        F.desc(F.coalesce("avg_risk_score", F.lit(0.0))), "id_beneficiario"
    )


def filter_alerts(alerts: DataFrame, detail: DataFrame, filters: Filters) -> DataFrame:
    conditions = _searched(
        filters, F.col("entity_id"), F.col("alert_type"), F.col("description"),
        F.col("uf"), F.col("sector").cast("bigint"), sector_display(F.col("sector")),
        _risk_display(F.col("risk_category")),
    )
    conditions += _entity_conditions(filters, "sector")
    if filters.level:
        conditions.append(F.col("level") == filters.level)
    visible = _visible_beneficiaries(detail, filters).withColumnRenamed("id_beneficiario", "entity_id")
    return alerts.where(_all_of(conditions)).join(visible, "entity_id", "left_semi").orderBy(
        "level", F.desc("risk_score"), "entity_id"
    )


def _entity_conditions(filters: Filters, sector_column: str) -> list[Column]:
    conditions = []
    if filters.uf:
        conditions.append(F.col("uf") == filters.uf)
    if filters.sector:
        conditions.append(
            F.coalesce(division(F.col(sector_column)), F.lit("-")) == filters.sector
        )
    if filters.risk:
        conditions.append(F.col("risk_category") == filters.risk)
    return conditions


def mean_with_gaps(column: Column) -> Column:
    """Mean in which a missing value counts as 0; 0 for no rows at all."""
    return F.coalesce(F.avg(F.coalesce(column.cast("double"), F.lit(0.0))), F.lit(0.0))


def _summary() -> dict[str, Column]:
    defaults = F.count_if(F.col(contracts.TARGET) == 1)
    display = F.coalesce(F.col("score_display"), F.lit(0.0)).cast(SCORE)
    rows = F.count(F.lit(1))
    return {
        "total": rows,
        "value": total(F.col("vlr_nominal")),
        "defaults": defaults,
        "default_rate": F.coalesce(F.try_divide(defaults.cast("double"), rows), F.lit(0.0)),
        "avg_score": F.coalesce(F.try_divide(F.sum(display).cast("double"), rows), F.lit(0.0)),
    }


def kpis(detail: DataFrame) -> DataFrame:
    """Headline numbers of the receivables in view."""
    beneficiaries = F.count_distinct(F.nullif("id_beneficiario", F.lit("")))
    return detail.agg(
        *[c.alias(n) for n, c in _summary().items()], beneficiaries.alias("beneficiaries")
    )


def summarise_by(detail: DataFrame, key: Column, name: str, **more: Column) -> DataFrame:
    """Headline numbers per group; a missing or empty key is shown as a dash."""
    shown = F.coalesce(F.nullif(key.cast("string"), F.lit("")), F.lit("-"))
    measures = {**_summary(), **more}
    return detail.groupBy(shown.alias(name)).agg(*[c.alias(n) for n, c in measures.items()])


def latest_months(per_month: DataFrame, months: int | None = MONTHS_SHOWN, name: str = "month") -> DataFrame:
    """The last ``months`` months (all for None), oldest first, without the group of missing dates."""
    known = per_month.where(F.col(name) != "-")
    if months is not None:
        known = known.orderBy(F.desc(name)).limit(months)
    return known.orderBy(name)


def default_rate_by_issue_month(detail: DataFrame, months: int | None = MONTHS_SHOWN) -> DataFrame:
    per_month = summarise_by(detail, dates.month_key(F.col("dt_emissao")), "month")
    return latest_months(per_month.select("month", "avg_score", "default_rate"), months)


def delay_by_issue_month(detail: DataFrame, months: int | None = MONTHS_SHOWN) -> DataFrame:
    delay = mean_with_gaps(F.col("payment_delay_days"))
    per_month = summarise_by(detail, dates.month_key(F.col("dt_emissao")), "month", delay=delay)
    return latest_months(per_month.select("month", "delay"), months)


def value_by_risk(detail: DataFrame) -> DataFrame:
    return summarise_by(detail, F.col("risk_category"), "risk").select("risk", "value")


def top_segments(detail: DataFrame, count: int = SEGMENTS_SHOWN) -> DataFrame:
    """The sectors with the most value."""
    liquidity = mean_with_gaps(F.col("beneficiary_cedente_indice_liquidez_1m"))
    groups = summarise_by(
        detail, division(F.col("entity_sector")), "division", liquidity=liquidity
    ).orderBy(F.desc("value"), "division").limit(count)
    name = F.when(
        F.col("division") == "-", F.lit(f"{fv.CNAE_DEFAULT_NAME} -")
    ).otherwise(text.cnae_label(F.col("division")))
    return groups.select(
        name.alias("segment"), "value", "default_rate", "liquidity",
        F.col("avg_score").alias("score"),
    ).orderBy(F.desc("value"), "segment")


def of_beneficiary(detail: DataFrame, beneficiary: str) -> DataFrame:
    return detail.where(F.col("id_beneficiario") == beneficiary)


def drilldown(detail: DataFrame, beneficiary: str, limit: int | None = None) -> DataFrame:
    """Receivables of one beneficiary in order, all or the first ``limit``."""
    rows = of_beneficiary(detail, beneficiary).orderBy("id_boleto")
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select("dt_emissao", "dt_vencimento", "dt_pagamento", "vlr_baixa", "tipo_baixa")


def selected_beneficiary(beneficiaries: DataFrame, beneficiary: str | None = None) -> DataFrame:
    """The profile row of one beneficiary; without a choice, of the riskiest (then the largest)."""
    if beneficiary is not None:
        return beneficiaries.where(F.col("id_beneficiario") == beneficiary)
    return beneficiaries.orderBy(
        F.desc_nulls_last("avg_risk_score"), F.desc_nulls_last("total_value"), "id_beneficiario"
    ).limit(1)


def view(
    detail: DataFrame, tables: dict[str, DataFrame], filters: Filters = Filters(), months: int | None = MONTHS_SHOWN,
) -> dict[str, DataFrame]:
    """Every panel over the receivables, beneficiaries and alerts that match the filters."""
    found = filter_transactions(detail, filters)
    beneficiaries = tables["beneficiary_risk"]
    alerts = filter_alerts(alerting.make_alerts(beneficiaries), detail, filters)
    shown = filter_beneficiaries(beneficiaries, detail, filters)
    return {
        "kpis": kpis(found),
        "segments": top_segments(found),
        "months": default_rate_by_issue_month(found, months),
        "delays": delay_by_issue_month(found, months),
        "value_by_risk": value_by_risk(found),
        "beneficiary_kpis": beneficiary_kpis(found),
        "aging": aging_buckets(found),
        "recall": high_risk_recall(found),
        "beneficiaries": shown,
        "selected_beneficiary": selected_beneficiary(shown),
        "alerts": alerts,
        "alert_counts": alerting.alert_counts(alerts),
    }


def beneficiary_kpis(detail: DataFrame) -> DataFrame:
    """Headline numbers of every beneficiary, with its mean delay and liquidity."""
    return summarise_by(
        detail, F.col("id_beneficiario"), "id_beneficiario",
        delay=mean_with_gaps(F.col("payment_delay_days")),
        liquidity=mean_with_gaps(F.col("beneficiary_cedente_indice_liquidez_1m")),
    )


def _aging() -> list[Column]:
    delay = F.coalesce(F.col("payment_delay_days"), F.lit(0))
    defaulted = F.coalesce(F.col(contracts.TARGET), F.lit(0))
    return [
        F.count_if((delay <= 0) & (defaulted == 0)),
        F.count_if((delay >= 1) & (delay <= 15)),
        F.count_if((delay > 15) & (delay <= 60)),
        F.count_if(delay > 60),
        F.count_if(F.col("dt_pagamento").isNull()),
    ]


def aging_buckets(detail: DataFrame) -> DataFrame:
    """Receivables per aging bucket and beneficiary; a missing delay counts as 0."""
    names = [f"_{i}" for i in range(len(fv.AGING_LABELS))]
    counted = detail.groupBy("id_beneficiario").agg(
        *[c.alias(n) for c, n in zip(_aging(), names)]
    )
    cells = F.array(*[
        F.struct(F.lit(label).alias("bucket"), F.col(n).alias("count"))
        for label, n in zip(fv.AGING_LABELS, names)
    ])
    return counted.select("id_beneficiario", F.explode(cells).alias("_c")).select(
        "id_beneficiario", "_c.*"
    )


def high_risk_recall(detail: DataFrame) -> DataFrame:
    """Share of the defaulted receivables that the score puts into the high band."""
    defaulted = F.col(contracts.TARGET) == 1
    caught = F.count_if(defaulted & (F.col("risk_category") == "high"))
    return detail.agg(
        caught.alias("caught"),
        F.count_if(defaulted).alias("defaulted"),
        (caught.cast("double") / F.greatest(F.lit(1), F.count_if(defaulted))).alias("recall"),
    )


def facets(detail: DataFrame) -> DataFrame:
    """Values offered by the filters, from one pass: issue months, states, sector divisions."""
    offered = {
        "period": F.col("period_month"),
        "uf": F.col("entity_uf"),
        "sector": division(F.col("entity_sector")),
    }
    cells = F.array(*[
        F.struct(F.lit(name).alias("facet"), column.alias("value")) for name, column in offered.items()
    ])
    values = detail.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").distinct()
    label = F.when(F.col("facet") == "sector", text.cnae_label(F.col("value"))).otherwise(F.col("value"))
    return values.withColumn("label", label).orderBy("facet", "label")


def panels(
    detail: DataFrame,
    tables: dict[str, DataFrame],
    importance: DataFrame | None = None,
    metrics: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every dataset behind the dashboard."""

    def with_display(df: DataFrame) -> DataFrame:
        return df.withColumn("score_display", risk.display_score(F.col("avg_risk_score")))

    beneficiaries = with_display(tables["beneficiary_risk"])
    payers = with_display(tables["payer_risk"])
    alerts = alerting.make_alerts(beneficiaries)
    result = {
        "summary": tables["portfolio_overview"],
        "filters": facets(detail),
        "transactions": compact(detail, TRANSACTION_COLUMNS),
        "beneficiaries": compact(beneficiaries, ENTITY_COLUMNS),
        "payers": compact(first_payers(payers), ENTITY_COLUMNS),
        "temporal": tables["temporal_analysis"],
        "uf_analysis": tables["uf_analysis"],
        "cnae_analysis": first_sectors(tables["cnae_analysis"]),
        "score_distribution": tables["score_distribution"],
        "alerts": compact(alerts, ALERT_COLUMNS),
    }
    if importance is not None:
        result["feature_importance"] = top_importance(importance)
    if metrics is not None:
        result["model_metrics"] = metrics
    shown = view(detail, tables, months=None)
    return result | {f"view_{name}": df for name, df in shown.items() if name not in ("beneficiaries", "alerts")}


def _first(df: DataFrame, rows: int | None, *order) -> DataFrame:
    df = df.orderBy(*order)
    return df if rows is None else df.limit(rows)


def first_sectors(cnae: DataFrame, rows: int | None = None) -> DataFrame:
    """Sectors, the largest of each perspective first; all, or as many as asked for."""
    return _first(cnae, rows, "perspective", F.desc("total_boletos"), "cd_cnae")


def first_payers(payers: DataFrame, rows: int | None = None) -> DataFrame:
    """Payers, the riskiest first; all, or as many as asked for."""
    return _first(payers, rows, F.desc_nulls_last("avg_risk_score"), F.desc("total_value"), "id_pagador")


def top_importance(importance: DataFrame, rows: int | None = None, per_model: bool = False) -> DataFrame:
    """Inputs by importance, over all models together or of each model; all, or the first ``rows``.

    Importances of different kinds of models have different scales, so the common list
    favours one kind; it is what the dashboard shows.
    """
    order = [F.desc("importance"), F.col("model"), F.col("feature")]
    if not per_model or rows is None:
        return _first(importance, rows, *order)
    rank = F.row_number().over(Window.partitionBy("model").orderBy(*order))
    kept = importance.withColumn("_rank", rank).where(F.col("_rank") <= rows)
    return kept.drop("_rank").orderBy("model", F.desc("importance"))
