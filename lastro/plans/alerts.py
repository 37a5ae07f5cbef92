"""Alerts on beneficiaries and the analyst's work queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro import fixed_values as fv
from lastro.functions import risk
from lastro.functions.measures import round_even


def _whole(value: Column) -> Column:
    """Half-even whole number as text."""
    return round_even(value, 0).cast("bigint").cast("string")


def make_alerts(
    beneficiaries: DataFrame, key: str = "id_beneficiario", candidates: int | None = None
) -> DataFrame:
    """Alerts of all beneficiaries, or of the ``candidates`` riskiest; an empty result stays an empty table."""
    top = beneficiaries
    if candidates is not None:
        top = beneficiaries.orderBy(
            F.desc_nulls_last("avg_risk_score"), F.desc_nulls_last("total_value"), key
        ).limit(candidates)
    score, rate, value = (
        F.coalesce(F.col(c), F.lit(0.0)) for c in ("avg_risk_score", "default_rate", "total_value")
    )
    kind = (
        F.when(score >= fv.ALERT_SCORE_CRITICAL, "critical")
        .when(rate >= fv.ALERT_DEFAULT_RATE, "overdue")
        .when(score >= fv.ALERT_SCORE_HIGH, "exposed")
    )
    before, middle, after = fv.ALERT_TEXT_CRITICAL
    texts = {
        "critical": F.concat(
            F.lit(before), _whole(score * 10), F.lit(middle), F.format_number(value, 0), F.lit(after)
        ),
        "overdue": F.concat(
            F.lit(fv.ALERT_TEXT_OVERDUE[0]),
            round_even(rate * 100, 1).cast("decimal(18,1)").cast("string"),
            F.lit(fv.ALERT_TEXT_OVERDUE[1]),
        ),
        "exposed": F.concat(
            F.lit(fv.ALERT_TEXT_EXPOSED[0]), _whole(score * 10), F.lit(fv.ALERT_TEXT_EXPOSED[1])
        ),
    }

    def by_kind(values: dict) -> Column:
        column = F.lit(None)
        for name, value_of_kind in values.items():
            shown = F.lit(value_of_kind) if isinstance(value_of_kind, str) else value_of_kind
            column = F.when(F.col("_kind") == name, shown).otherwise(column)
        return column

    part = [{k: v[i] for k, v in fv.ALERT_KINDS.items()} for i in range(3)]
    return (
        top.withColumn("_kind", kind).where(F.col("_kind").isNotNull())
        .select(
            F.lit(fv.ALERT_ENTITY_TYPE).alias("entity_type"),
            F.col(key).alias("entity_id"),
            "uf",
            F.col("cd_cnae_prin").alias("sector"),
            "risk_category",
            score.alias("risk_score"),
            risk.display_score(score).cast("bigint").alias("score_display"),
            rate.alias("default_rate"),
            value.alias("total_value"),
            by_kind(part[0]).alias("alert_type"),
            by_kind(part[1]).alias("level"),
            by_kind(part[2]).alias("status"),
            by_kind(texts).alias("description"),
        )
        .orderBy("level", F.desc("risk_score"), "entity_id")
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """All, critical, score and operational alerts."""
    by_score = F.col("alert_type") == fv.ALERT_KINDS["critical"][0]
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("level") == fv.ALERT_KINDS["critical"][1]).alias("critical"),
        F.count_if(by_score).alias("score_alerts"),
        F.count_if(~by_score).alias("operational"),
    )


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    kind = F.coalesce(F.nullif("alert_type", F.lit("")), F.lit("-")).alias("alert_type")
    return alerts.groupBy(kind).agg(F.count(F.lit(1)).alias("count"))


def priority_queue(entities: DataFrame, key: str, length: int | None = None) -> DataFrame:
    """Who to look at first: high risk, then score, exposure and number of receivables."""
    queue = entities.orderBy(
        F.desc(F.col("risk_category") == "high"),
        F.desc_nulls_last("avg_risk_score"), F.desc("total_value"), F.desc("total_boletos"), key,
    )
    return queue if length is None else queue.limit(length)
