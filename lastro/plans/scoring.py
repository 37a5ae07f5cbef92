"""Rule-based risk score, used where no model has been trained.

The score of a receivable depends on attributes of its payer and on five portfolio
statistics: minimum and maximum of delay and materiality, and the median liquidity.  The
statistics weigh a company by its number of receivables, so they are fitted on one row
per payer.  They are five numbers, which is all that passes through the driver; scoring
is then a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro import contracts
from lastro import fixed_values as fv
from lastro.contracts import PAYER
from lastro.functions import risk
from lastro.operators.ranking import exact_quantiles
from lastro.plans.enrichment import enrich
from lastro.plans.features import add_label
from lastro.functions.measures import round_even

_DELAY, _OVERDUE = "media_atraso_dias", "share_vl_inad_pag_bol_6_a_15d"
_LIQUIDITY, _MATERIALITY = "sacado_indice_liquidez_1m", "score_materialidade_evolucao"


def weighted_payers(payments: DataFrame, auxiliary: DataFrame) -> DataFrame:
    """One row per known payer with its attributes and ``n``, its number of receivables."""
    counts = payments.groupBy(PAYER.key).agg(F.count(F.lit(1)).alias("n"))
    companies = auxiliary.select(
        F.col(contracts.COMPANY_KEY).alias(PAYER.key), _DELAY, _LIQUIDITY, _MATERIALITY
    )
    return counts.join(companies, PAYER.key)


def normalise(df: DataFrame, column: str) -> Column:
    """Min-max scaling of one column over the whole table."""
    ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    return risk.min_max(F.col(column), ends["low"], ends["high"])


@dataclass(frozen=True)
class RuleScore:
    """Fitted statistics of the rule-based score; None where no company has a value."""

    delay: tuple[float | None, float | None]
    materiality: tuple[float | None, float | None]
    liquidity: float | None

    @staticmethod
    def fit(payments: DataFrame, auxiliary: DataFrame) -> RuleScore:
        """One job; the quantiles at 0 and 1 are minimum and maximum."""
        measures = {c: F.col(c) for c in (_DELAY, _MATERIALITY, _LIQUIDITY)}
        payers = weighted_payers(payments, auxiliary)
        found = {
            r["series"]: (r["q0"], r["q1"], r["q2"])
            for r in exact_quantiles(payers, measures, (0, 0.5, 1), weight=F.col("n")).collect()
        }
        nothing = (None, None, None)
        delay, materiality = found.get(_DELAY, nothing), found.get(_MATERIALITY, nothing)
        return RuleScore(
            (delay[0], delay[2]), (materiality[0], materiality[2]), found.get(_LIQUIDITY, nothing)[1]
        )

    def points(self) -> Column:
        """Score over the payer columns of an enriched receivable, before rounding."""

        def payer(column: str) -> Column:
            return F.col(f"{PAYER.prefix}_{column}")

        def scaled(column: str, ends: tuple[float | None, float | None]) -> Column:
            low, high = (F.lit(end).cast("double") for end in ends)
            return risk.min_max(payer(column), low, high)

        median = F.lit(self.liquidity).cast("double")
        overdue = risk.clip(F.coalesce(payer(_OVERDUE), F.lit(0.0)), 0.0, 1.0)
        liquidity = risk.clip(F.coalesce(payer(_LIQUIDITY), median), 0.0, 1.0)
        points = (
            fv.WEIGHT_DELAY * scaled(_DELAY, self.delay)
            + fv.WEIGHT_OVERDUE * overdue
            + fv.WEIGHT_ILLIQUIDITY * (1 - liquidity)
            + fv.WEIGHT_MATERIALITY * scaled(_MATERIALITY, self.materiality)
        )
        return risk.clip(points, 0.0, 100.0)

    def score(self, enriched: DataFrame) -> DataFrame:
        """Add score, probability and band."""
        scored = enriched.withColumn("risk_score", round_even(self.points(), 1))
        return scored.withColumns({
            "default_probability": round_even(F.col("risk_score") / 100, 4),
            "risk_category": risk.risk_band(F.col("risk_score"), scale=100),
        })


def score_by_rules(payments: DataFrame, auxiliary: DataFrame, validate: bool = False) -> DataFrame:
    """Enriched and labelled receivables with score, probability and band."""
    fitted = RuleScore.fit(payments, auxiliary)
    return fitted.score(add_label(enrich(payments, auxiliary, validate)))


def published_scores(scored: DataFrame) -> DataFrame:
    """The 14 columns of the published score table."""
    columns = (
        *contracts.IDENTIFIERS, *contracts.DATES, contracts.TARGET, *contracts.SCORE_CONTEXT,
        "default_probability", "risk_score", "risk_category",
    )
    return scored.select(*[c for c in columns if c in scored.columns])
