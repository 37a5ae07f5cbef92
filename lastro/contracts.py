"""Declared data contracts of the two incoming tables and the column roles.

A contract maps a column name to a :class:`ColumnSpec`.  Scans, cleaning,
quality checks and model preparation all read their column lists from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from lastro import fixed_values as fv


@dataclass(frozen=True)
class ColumnSpec:
    """What one column has to look like; ``baseline_null_rate`` is the share of nulls seen so far."""

    data_type: T.DataType
    nullable: bool = True
    unique: bool = False
    min_value: float | None = None
    max_value: float | None = None
    allowed: tuple[str, ...] | None = None
    baseline_null_rate: float = 0.0

    def null_rate_threshold(self) -> float:
        base = self.baseline_null_rate
        return max(base * fv.NULL_RATE_FACTOR, base + fv.NULL_RATE_MARGIN)


_TEXT, _DATE, _NUMBER = T.StringType(), T.DateType(), T.DoubleType()

PAYMENTS = {
    "id_boleto": ColumnSpec(_TEXT, nullable=False, unique=True),
    "id_pagador": ColumnSpec(_TEXT, nullable=False),
    "id_beneficiario": ColumnSpec(_TEXT, nullable=False),
    "dt_emissao": ColumnSpec(_DATE, nullable=False),
    "dt_vencimento": ColumnSpec(_DATE, nullable=False),
    "dt_pagamento": ColumnSpec(_DATE, baseline_null_rate=0.0098),
    "vlr_nominal": ColumnSpec(_NUMBER, nullable=False, min_value=0.01),
    "vlr_baixa": ColumnSpec(_NUMBER, min_value=0.01, baseline_null_rate=0.1152),
    "tipo_baixa": ColumnSpec(_TEXT, allowed=fv.SETTLEMENT_LABELS, baseline_null_rate=0.0098),
    "tipo_especie": ColumnSpec(_TEXT, nullable=False, allowed=fv.INSTRUMENT_LABELS),
}


def _score(high: float | None, baseline: float) -> ColumnSpec:
    return ColumnSpec(_NUMBER, min_value=0.0, max_value=high, baseline_null_rate=baseline)


AUXILIARY = {
    "id_cnpj": ColumnSpec(_TEXT, nullable=False, unique=True),
    "cd_cnae_prin": ColumnSpec(
        _NUMBER, min_value=100_000.0, max_value=9_999_999.0, baseline_null_rate=0.0004
    ),
    "uf": ColumnSpec(_TEXT, allowed=fv.STATES, baseline_null_rate=0.0778),
    "sacado_indice_liquidez_1m": _score(1.0, 0.0041),
    "cedente_indice_liquidez_1m": _score(1.0, 0.4659),
    "score_materialidade_evolucao": _score(1000.0, 0.0007),
    "media_atraso_dias": _score(None, 0.0011),
    "indicador_liquidez_quantitativo_3m": _score(1.0, 0.0043),
    "share_vl_inad_pag_bol_6_a_15d": _score(1.0, 0.0011),
    "score_quantidade_v2": _score(1000.0, 0.0013),
    "score_materialidade_v2": _score(1000.0, 0.0013),
}

COMPANY_KEY = "id_cnpj"
COMPANY_ATTRIBUTES = tuple(c for c in AUXILIARY if c != COMPANY_KEY)


@dataclass(frozen=True)
class Role:
    """How a company takes part in a receivable."""

    prefix: str
    key: str
    expected_match_rate: float = 1.0


PAYER = Role("payer", "id_pagador")
BENEFICIARY = Role("beneficiary", "id_beneficiario")
ROLES = (PAYER, BENEFICIARY)

# Column roles for model input.  A column is exactly one of these.
IDENTIFIERS = ("id_boleto", PAYER.key, BENEFICIARY.key)
TARGET = "is_defaulted"
DATES = ("dt_emissao", "dt_vencimento")
LEAKY_DIRECT = (
    "dt_pagamento", "payment_delay_days", "days_overdue",
    "vlr_baixa", "tipo_baixa", "settlement_code",
)
LEAKY_INDIRECT = (
    "payer_default_rate", "payer_avg_delay_days", "payer_max_delay_days",
    "payer_boleto_count", "payer_avg_nominal_value", "payer_avg_term_days",
    "beneficiary_default_rate", "beneficiary_boleto_count",
    "beneficiary_avg_nominal_value", "beneficiary_total_portfolio_value",
)
LEAKY = LEAKY_DIRECT + LEAKY_INDIRECT
NUMERIC_FEATURES = (
    "vlr_nominal", "boleto_term_days", "due_month", "due_day_of_week",
    *(f"{role.prefix}_{score}" for role in ROLES for score in fv.COMPANY_SCORES),
)
CATEGORICAL_FEATURES = (
    "tipo_especie", "payer_uf", "beneficiary_uf",
    "payer_cd_cnae_prin", "beneficiary_cd_cnae_prin",
)
SAFE_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
SCORE_CONTEXT = (
    "payer_uf", "beneficiary_uf", "payer_cd_cnae_prin", "beneficiary_cd_cnae_prin", "vlr_nominal",
)


def columns_of(contract: dict[str, ColumnSpec], data_type: type[T.DataType]) -> list[str]:
    return [name for name, spec in contract.items() if isinstance(spec.data_type, data_type)]


def struct_type(contract: dict[str, ColumnSpec]) -> T.StructType:
    """The contract as a Spark schema; the rules travel as field metadata."""
    fields = []
    for name, spec in contract.items():
        rules = {
            "unique": spec.unique,
            "min_value": spec.min_value,
            "max_value": spec.max_value,
            "allowed": list(spec.allowed) if spec.allowed else None,
            "baseline_null_rate": spec.baseline_null_rate,
        }
        kept = {k: v for k, v in rules.items() if v is not None}
        fields.append(T.StructField(name, spec.data_type, spec.nullable, kept))
    return T.StructType(fields)


def overlapping_roles() -> set[str]:
    """Columns that were given more than one role; has to stay empty."""
    groups = (IDENTIFIERS, (TARGET,), DATES, LEAKY, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    seen, twice = set(), set()
    for column in (c for group in groups for c in group):
        (twice if column in seen else seen).add(column)
    return twice
