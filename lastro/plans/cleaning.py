"""Cleaning of the two incoming tables and the removal of repeated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.functions import text
from lastro.operators.dedup import keep_one


def clean_payments(df: DataFrame) -> DataFrame:
    """Trim the labels and decode the settlement code."""
    trimmed = df.withColumns({c: text.strip(F.col(c)) for c in ("tipo_baixa", "tipo_especie")})
    return trimmed.withColumn("settlement_code", text.settlement_code(F.col("tipo_baixa")))


def clean_auxiliary(df: DataFrame) -> DataFrame:
    """Trim and upper-case the state; the sector code is a whole number and must not carry a fraction."""
    code = F.col("cd_cnae_prin")
    whole = F.when(
        code.isNull() | (code == F.floor(code)), code.cast("bigint")
    ).otherwise(F.raise_error(F.concat(F.lit("fractional sector code "), code.cast("string"))).cast("bigint"))
    return df.withColumns({"uf": F.upper(text.strip(F.col("uf"))), "cd_cnae_prin": whole})


def deduplicate(df: DataFrame, key: str, order: Column, keep: str | bool = "last") -> DataFrame:
    return keep_one(df, [key], order, keep)
