"""Features of a receivable: dates and label, and the behaviour of its payer and beneficiary.

The aggregates of a role need payments columns only, and so do not wait for the company
attributes.  ``build_features`` puts the aggregates and the attributes of a company into
one profile and joins it once, so the wide receivables table is shuffled once per role
instead of twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro import contracts
from lastro import fixed_values as fv
from lastro.contracts import PAYER, Role
from lastro.functions import dates
from lastro.functions.measures import mean, total
from lastro.operators.joins import left_join_many_to_one
from lastro.plans.enrichment import company_profile
from lastro.session import stored


def add_label(df: DataFrame, threshold: int = fv.DEFAULT_THRESHOLD_DAYS) -> DataFrame:
    """Delay and default label."""
    delay = dates.delay_days(F.col("dt_vencimento"), F.col("dt_pagamento"))
    return df.withColumn("payment_delay_days", delay).withColumn(
        contracts.TARGET,
        dates.default_flag(F.col("dt_pagamento"), F.col("payment_delay_days"), threshold),
    )


def add_temporal_features(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Term, delay, overdue days, label, due month and weekday (Monday is 0)."""
    issued, due, paid = (F.col(c) for c in ("dt_emissao", "dt_vencimento", "dt_pagamento"))
    return add_label(df).withColumns({
        "boleto_term_days": dates.term_days(issued, due),
        "days_overdue": dates.days_overdue(due, paid, as_of),
        "due_month": F.month(due),
        "due_day_of_week": F.weekday(due),
    })


def _aggregates(role: Role) -> list[Column]:
    if role == PAYER:
        return [
            F.count("id_boleto").alias("payer_boleto_count"),
            F.avg(contracts.TARGET).alias("payer_default_rate"),
            mean(F.col("vlr_nominal")).alias("payer_avg_nominal_value"),
            F.avg("payment_delay_days").alias("payer_avg_delay_days"),
            F.max("payment_delay_days").alias("payer_max_delay_days"),
            F.avg("boleto_term_days").alias("payer_avg_term_days"),
        ]
    return [
        F.count("id_boleto").alias("beneficiary_boleto_count"),
        F.avg(contracts.TARGET).alias("beneficiary_default_rate"),
        mean(F.col("vlr_nominal")).alias("beneficiary_avg_nominal_value"),
        total(F.col("vlr_nominal")).alias("beneficiary_total_portfolio_value"),
    ]


def behaviour(df: DataFrame, role: Role) -> DataFrame:
    """Aggregates per company of a role, with ``_rows`` for the join back.  Null keys have none."""
    rows = F.count(F.lit(1)).alias("_rows")
    known = df.where(F.col(role.key).isNotNull())
    return known.groupBy(role.key).agg(*_aggregates(role), rows)


def add_behaviour(df: DataFrame, role: Role, **skew) -> DataFrame:
    """Aggregates of a role joined back to every receivable."""
    profile = stored(behaviour(df, role), f"{role.prefix}-behaviour")
    counts = profile.select(role.key, "_rows")
    joined = left_join_many_to_one(
        df, profile.drop("_rows"), role.key, "id_boleto", counts, **skew
    )
    added = [c for c in profile.columns if c not in (role.key, "_rows")]
    return joined.select(*df.columns, *added)


def build_features(
    payments: DataFrame, auxiliary: DataFrame, as_of: Column | None = None, **skew
) -> DataFrame:
    """Enriched receivables with all features, 47 columns for cleaned payments.

    The profiles are stored: they are read both for the join and for its key counts, and
    their real size decides whether the wide table has to be shuffled at all.
    """
    temporal_table = add_temporal_features(payments, as_of)
    df = temporal_table
    for role in contracts.ROLES:
        totals = behaviour(temporal_table, role)
        profile = stored(
            totals.join(company_profile(auxiliary, role), role.key, "left"), f"{role.prefix}-profile"
        )
        counts = profile.select(role.key, "_rows")
        df = left_join_many_to_one(
            df, profile.drop("_rows"), role.key, "id_boleto", counts, **skew
        )
    enriched = [
        f"{role.prefix}_{c}" for role in contracts.ROLES for c in contracts.COMPANY_ATTRIBUTES
    ]
    temporal = [c for c in temporal_table.columns if c not in payments.columns]
    aggregates = [c for c in df.columns if c not in {*payments.columns, *enriched, *temporal}]
    return df.select(*payments.columns, *enriched, *temporal, *aggregates)
