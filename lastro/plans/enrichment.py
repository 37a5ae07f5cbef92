"""Company attributes on every receivable, once per role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro import contracts
from lastro import fixed_values as fv
from lastro.contracts import Role
from lastro.operators.joins import (
    MIN_HOT_ROWS, SMALL_BYTES, is_small, key_counts, left_join_many_to_one, require_unique,
)
from lastro.session import stored


def company_profile(auxiliary: DataFrame, role: Role) -> DataFrame:
    """Company attributes prefixed with the role, keyed like the payments column."""
    return auxiliary.select(
        F.col(contracts.COMPANY_KEY).alias(role.key),
        *[F.col(c).alias(f"{role.prefix}_{c}") for c in contracts.COMPANY_ATTRIBUTES],
    )


def enrich_role(
    payments: DataFrame, auxiliary: DataFrame, role: Role, validate: bool = True,
    counts: DataFrame | None = None, min_hot_rows: int = MIN_HOT_ROWS, small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Left many-to-one join; ``validate=False`` when the key is unique by construction."""
    if validate:
        require_unique(auxiliary, contracts.COMPANY_KEY)
    profile = company_profile(auxiliary, role)
    joined = left_join_many_to_one(
        payments, profile, role.key, row_id="id_boleto", counts=counts,
        min_hot_rows=min_hot_rows, small_bytes=small_bytes,
    )
    return joined.select(*payments.columns, *[c for c in profile.columns if c != role.key])


def enrich(
    payments: DataFrame, auxiliary: DataFrame, validate: bool = True,
    min_hot_rows: int = MIN_HOT_ROWS, small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Payer and beneficiary attributes on every receivable.

    When the company table is not small, the keys of both roles are counted before the first join, in one
    pass over the two key columns, and each role is joined with the companies that occur in it.  These are stored, so that
    their real size decides whether the wide table has to be shuffled: a few beneficiaries of many companies are broadcast.
    """
    if validate:
        require_unique(auxiliary, contracts.COMPANY_KEY)
    counts = {}
    if not all(is_small(company_profile(auxiliary, role), small_bytes) for role in contracts.ROLES):
        counts = key_counts(payments, [role.key for role in contracts.ROLES])
    df = payments
    for role in contracts.ROLES:
        companies = auxiliary
        if counts:
            occur = counts[role.key].select(F.col(role.key).alias(contracts.COMPANY_KEY))
            companies = stored(auxiliary.join(occur, contracts.COMPANY_KEY, "left_semi"), f"{role.prefix}-companies")
        df = enrich_role(
            df, companies, role, validate=False, counts=counts.get(role.key),
            min_hot_rows=min_hot_rows, small_bytes=small_bytes,
        )
    return df


def match_rates(payments: DataFrame, auxiliary: DataFrame) -> DataFrame:
    """Share of receivables whose company is known, per role, with the alarm of each role.

    Receivables are counted per company before the join, so that the join sees each
    company once and no company key is hot.  A null key counts as unmatched.
    """
    known = auxiliary.select(F.col(contracts.COMPANY_KEY).alias("company"), F.lit(True).alias("_known"))
    cells = F.array(*[
        F.struct(
            F.lit(role.prefix).alias("role"),
            F.lit(role.expected_match_rate).alias("expected"),
            F.col(role.key).alias("company"),
        )
        for role in contracts.ROLES
    ])
    counted = (
        payments.select(F.explode(cells).alias("c")).select("c.*")
        .groupBy("role", "expected", "company").agg(F.count(F.lit(1)).alias("n"))
    )
    matched = F.sum(F.when(F.col("_known"), F.col("n")).otherwise(F.lit(0)))
    rate = F.try_divide(matched.cast("double"), F.sum("n"))
    return (
        counted.join(known.dropDuplicates(["company"]), "company", "left")
        .groupBy("role", "expected")
        .agg(F.sum("n").alias("rows"), matched.alias("matched"), rate.alias("match_rate"))
        .withColumn("below_expected", F.col("match_rate") < F.col("expected") - fv.MATCH_RATE_SLACK)
        .select("role", "rows", "matched", "match_rate", "below_expected")
    )
