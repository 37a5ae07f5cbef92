"""Published portfolio tables, all aggregated from the scored receivables.

``keep_null_keys`` and ``rounded`` choose between the regular tables (null groups dropped,
values rounded) and the tables built directly from raw files (null groups kept, values
as they are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastro import contracts
from lastro.contracts import Role
from lastro.functions import dates, risk
from lastro.functions.measures import MONEY, PROBABILITY, SCORE, mean, round_even, share, total

_LABEL = contracts.TARGET


def _count() -> Column:
    return F.count("id_boleto")


def _group_measures() -> list[Column]:
    """Measures shared by every segment table."""
    return [
        _count().alias("total_boletos"),
        total(F.col("vlr_nominal")).alias("total_value"),
        F.coalesce(F.sum(_LABEL), F.lit(0)).alias("defaulted_boletos"),
        F.avg(_LABEL).alias("default_rate"),
        mean(F.col("risk_score"), SCORE).alias("avg_risk_score"),
        mean(F.col("default_probability"), PROBABILITY).alias("avg_default_probability"),
    ]


_DIGITS = {
    "total_value": 2, "avg_boleto_value": 2, "default_rate": 4,
    "avg_default_probability": 4, "avg_risk_score": 2, "max_risk_score": 2,
}


def _round(df: DataFrame, rounded: bool) -> DataFrame:
    if not rounded:
        return df
    return df.withColumns({c: round_even(c, n) for c, n in _DIGITS.items() if c in df.columns})


def portfolio_overview(df: DataFrame) -> DataFrame:
    """One row of totals; rates are null on an empty portfolio."""
    value, defaulted = F.col("vlr_nominal"), F.col(_LABEL) == 1
    bands = {b: F.col("risk_category") == b for b in ("high", "medium", "low")}
    sums = df.agg(
        F.count(F.lit(1)).alias("total_boletos"),
        F.coalesce(F.sum(_LABEL), F.lit(0)).alias("defaulted_boletos"),
        total(value).alias("total_portfolio_value"),
        total(F.when(defaulted, value)).alias("defaulted_portfolio_value"),
        total(F.when(~F.coalesce(defaulted, F.lit(False)), value)).alias("non_defaulted_value"),
        round_even(mean(value), 2).alias("avg_boleto_value"),
        round_even(mean(F.col("risk_score"), SCORE), 2).alias("avg_risk_score"),
        *[F.count_if(c).alias(f"{b}_risk_count") for b, c in bands.items()],
        *[round_even(share(c), 4).alias(f"{b}_risk_rate") for b, c in bands.items()],
    )
    rate = F.try_divide(F.col("defaulted_boletos").cast("double"), F.col("total_boletos"))
    return sums.select(
        "total_boletos",
        "defaulted_boletos",
        (F.col("total_boletos") - F.col("defaulted_boletos")).alias("non_defaulted_boletos"),
        round_even(rate, 4).alias("default_rate"),
        "total_portfolio_value", "defaulted_portfolio_value", "non_defaulted_value",
        "avg_boleto_value", "avg_risk_score",
        *[f"{b}_risk_count" for b in bands],
        *[f"{b}_risk_rate" for b in bands],
    )


def entity_risk(
    df: DataFrame,
    role: Role,
    keep_null_keys: bool = False,
    band_on_score: bool = False,
    rounded: bool = True,
) -> DataFrame:
    """Risk per payer or beneficiary, riskiest first.

    State and sector depend on the company.  They are grouping keys of the first step, so
    that the receivables go through a hash aggregate, and become one value per company in
    the second, over the few rows left.  The band follows the unrounded mean, of the
    probability or of the score.
    """
    rows = df if keep_null_keys else df.where(F.col(role.key).isNotNull())
    uf, sector = f"{role.prefix}_uf", f"{role.prefix}_cd_cnae_prin"
    summed = {
        "vlr_nominal": MONEY, _LABEL: "int", "risk_score": SCORE, "default_probability": PROBABILITY,
    }
    first = [_count().alias("_rows"), F.max("risk_score").alias("_max")]
    for column, kind in summed.items():
        first += [
            F.sum(F.col(column).cast(kind)).alias(f"_sum_{column}"),
            F.count(column).alias(f"_count_{column}"),
        ]
    companies = rows.groupBy(role.key, uf, sector).agg(*first)

    def added(column: str) -> Column:
        return F.sum(f"_sum_{column}").cast("double")

    def mean_of(column: str) -> Column:
        return F.try_divide(added(column), F.sum(f"_count_{column}"))

    grouped = companies.groupBy(role.key).agg(
        F.sum("_rows").alias("total_boletos"),
        F.coalesce(added("vlr_nominal"), F.lit(0.0)).alias("total_value"),
        mean_of("vlr_nominal").alias("avg_boleto_value"),
        F.coalesce(F.sum(f"_sum_{_LABEL}"), F.lit(0)).alias("defaulted_boletos"),
        mean_of(_LABEL).alias("default_rate"),
        mean_of("default_probability").alias("avg_default_probability"),
        mean_of("risk_score").alias("avg_risk_score"),
        F.max("_max").alias("max_risk_score"),
        F.max(uf).alias("uf"),
        F.max(sector).alias("cd_cnae_prin"),
    )
    if band_on_score:
        band = risk.risk_band(F.col("avg_risk_score"), scale=100)
    else:
        band = risk.risk_band(F.col("avg_default_probability"))
    ordered = grouped.withColumn("risk_category", band).orderBy(
        F.desc_nulls_last("avg_risk_score"), F.desc("total_value"), role.key
    )
    return _round(ordered, rounded).select(
        role.key, "total_boletos", "total_value", "avg_boleto_value", "defaulted_boletos",
        "default_rate", "avg_default_probability", "avg_risk_score", "max_risk_score",
        "uf", "cd_cnae_prin", "risk_category",
    )


def temporal_analysis(df: DataFrame, rounded: bool = True) -> DataFrame:
    """Risk per due month."""
    month = dates.month_key(F.col("dt_vencimento")).alias("due_year_month")
    high = F.count_if(F.col("risk_category") == "high").alias("high_risk_count")
    grouped = df.groupBy(month).agg(*_group_measures(), high)
    return _round(grouped.orderBy("due_year_month"), rounded)


def segment_analysis(
    df: DataFrame,
    attribute: str,
    name: str,
    first: str | None = None,
    keep_null_keys: bool = False,
    rounded: bool = True,
) -> DataFrame:
    """Risk per value of a company attribute, seen from the payer and from the beneficiary.

    Each receivable is read once and counted under both perspectives.  ``first`` names the
    measure the groups are sorted by, largest first.
    """
    views = F.array(*[
        F.struct(
            F.lit(role.prefix).alias("perspective"),
            F.col(f"{role.prefix}_{attribute}").alias(name),
        )
        for role in contracts.ROLES
    ])
    needed = ("id_boleto", "vlr_nominal", _LABEL, "risk_score", "default_probability")
    rows = df.select(F.explode(views).alias("_view"), *needed).select("_view.*", *needed)
    if not keep_null_keys:
        rows = rows.where(F.col(name).isNotNull())
    grouped = rows.groupBy("perspective", name).agg(*_group_measures())
    if first:
        grouped = grouped.orderBy("perspective", F.desc(first), name)
    return _round(grouped, rounded)


def uf_analysis(df: DataFrame, **options) -> DataFrame:
    """Per state; the highest (unrounded) default rate first within a perspective."""
    return segment_analysis(df, "uf", "uf", first="default_rate", **options)


def cnae_analysis(df: DataFrame, **options) -> DataFrame:
    """Per sector code; the largest group first within a perspective."""
    return segment_analysis(df, "cd_cnae_prin", "cd_cnae", first="total_boletos", **options)


def probability_bucket(probability: Column, edges: list[float]) -> Column:
    """Index of the right-closed bin, the first bin closed on both sides; null outside."""
    bucket = F.when((probability < edges[0]) | (probability > edges[-1]), None)
    for i, edge in enumerate(edges[1:]):
        bucket = bucket.when(probability <= edge, i)
    return bucket


def score_distribution(df: DataFrame, from_raw: bool = False) -> DataFrame:
    """Receivables per tenth of the probability scale.

    Regular edges are multiples of 0.1 in floating point, raw edges the nearest numbers to
    the tenths; a missing probability is 0 in the raw variant, which has no portfolio share.
    """
    edges = [i / 10 if from_raw else i * 0.1 for i in range(11)]
    probability = F.col("default_probability")
    if from_raw:
        probability = F.coalesce(probability, F.lit(0.0))
    bucket = probability_bucket(probability, edges)
    grouped = df.groupBy(bucket.alias("bucket_idx")).agg(
        _count().alias("boleto_count"),
        F.coalesce(F.sum(_LABEL), F.lit(0)).alias("actual_default_count"),
        F.avg(_LABEL).alias("actual_default_rate"),
        total(F.col("vlr_nominal")).alias("total_value"),
        F.count(F.lit(1)).alias("_rows"),
    )
    low = F.col("bucket_idx") * 10
    label = F.concat(low.cast("string"), F.lit("-"), (low + 10).cast("string"), F.lit("%"))
    columns = [label.alias("probability_bucket"), "bucket_idx", "boleto_count", "actual_default_count"]
    if from_raw:
        columns += ["actual_default_rate", "total_value"]
    else:
        # The window spans at most eleven rows: ten bins and the rows outside of them.
        everything = F.sum("_rows").over(Window.partitionBy(F.lit(1)))
        grouped = grouped.withColumn(
            "pct_of_portfolio", round_even(F.col("boleto_count") / everything, 4)
        )
        columns += [
            round_even("actual_default_rate", 4).alias("actual_default_rate"),
            round_even("total_value", 2).alias("total_value"),
            "pct_of_portfolio",
        ]
    return grouped.where("bucket_idx IS NOT NULL").select(*columns).orderBy("bucket_idx")


def published_tables(scored: DataFrame) -> dict[str, DataFrame]:
    """The seven portfolio tables."""
    payer, beneficiary = contracts.ROLES
    return {
        "portfolio_overview": portfolio_overview(scored),
        "payer_risk": entity_risk(scored, payer),
        "beneficiary_risk": entity_risk(scored, beneficiary),
        "temporal_analysis": temporal_analysis(scored),
        "uf_analysis": uf_analysis(scored),
        "cnae_analysis": cnae_analysis(scored),
        "score_distribution": score_distribution(scored),
    }


def tables_from_raw(scored: DataFrame) -> dict[str, DataFrame]:
    """The same tables for data that did not pass through cleaning and a model."""
    payer, beneficiary = contracts.ROLES
    entity = {"keep_null_keys": True, "band_on_score": True, "rounded": False}
    segment = {"keep_null_keys": True, "rounded": False}
    overview = (
        "total_boletos", "defaulted_boletos", "default_rate", "total_portfolio_value",
        "avg_boleto_value", "avg_risk_score", "high_risk_count", "medium_risk_count",
        "low_risk_count",
    )
    return {
        "portfolio_overview": portfolio_overview(scored).select(*overview),
        "payer_risk": entity_risk(scored, payer, **entity),
        "beneficiary_risk": entity_risk(scored, beneficiary, **entity),
        "temporal_analysis": temporal_analysis(scored, rounded=False),
        "uf_analysis": segment_analysis(scored, "uf", "uf", **segment),
        "cnae_analysis": segment_analysis(scored, "cd_cnae_prin", "cd_cnae", **segment),
        "score_distribution": score_distribution(scored, from_raw=True),
        "boleto_scores": scored,
    }
