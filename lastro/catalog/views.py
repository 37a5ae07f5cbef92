"""Receivables and companies derived from the order and customer tables.

The texts run unchanged in Spark SQL and in the checking engine.  An order is a
receivable, its customer the payer, and the lowest supplier key among its lines the
beneficiary.  Attributes come from integer arithmetic on the keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.plans import cleaning, dashboard, features, portfolio, scoring
from lastro.plans import alerts as alerting
from lastro import contracts
from lastro.session import stored

BASE_TABLES = ("orders", "lineitem", "customer", "supplier")

PAYMENTS_SQL = """
WITH m AS (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey),
x AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, m.sk,
         cast(o_orderdate AS date) AS e,
         cast(o_orderdate AS date) + cast(CASE substring(o_orderpriority, 1, 1)
             WHEN '1' THEN 15 WHEN '2' THEN 30 WHEN '3' THEN 45 WHEN '4' THEN 60 ELSE 90 END AS int) AS v,
         cast((o_orderkey * 37) % 30 - 28 + (o_custkey % 7) * 2 AS int) AS delay,
         (o_orderkey * 13) % 101 = 0 AS is_open,
         CASE WHEN o_orderkey % 20 = 3 THEN 5 WHEN o_orderkey % 20 = 7 THEN 7
              WHEN o_orderkey % 20 = 11 THEN 9 WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS code
  FROM orders JOIN m ON o_orderkey = m.l_orderkey)
SELECT concat('B', cast(o_orderkey AS string)) AS id_boleto,
       concat('C', cast(o_custkey AS string))  AS id_pagador,
       concat('S', cast(sk AS string))         AS id_beneficiario,
       e AS dt_emissao, v AS dt_vencimento,
       CASE WHEN is_open THEN NULL ELSE v + delay END AS dt_pagamento,
       o_totalprice AS vlr_nominal,
       CASE WHEN is_open OR code IN (5, 7) THEN NULL ELSE o_totalprice END AS vlr_baixa,
       CASE WHEN is_open THEN NULL
            WHEN code = 0 THEN '0 - Baixa integral interbancaria'
            WHEN code = 1 THEN '1 - Baixa integral intrabancaria'
            WHEN code = 5 THEN '5 - Baixa integral por solicitacao do cedente'
            WHEN code = 7 THEN '7 - Baixa integral por decurso de prazo'
            ELSE '9 - Baixa integral interbancaria - Liquidacao via STR' END AS tipo_baixa,
       CASE substring(o_orderpriority, 1, 1)
            WHEN '1' THEN 'DM DUPLICATA MERCANTIL' WHEN '2' THEN 'DMI DUPLICATA MERCANTIL INDICACAO'
            WHEN '3' THEN 'DS DUPLICATA DE SERVICO' WHEN '4' THEN 'NF NOTA FISCAL' ELSE 'OUTROS' END AS tipo_especie
FROM x
"""

AUXILIARY_SQL = """
WITH c AS (
  SELECT concat('C', cast(c_custkey AS string)) AS id_cnpj, c_custkey AS k, c_nationkey AS nk FROM customer
  UNION ALL
  SELECT concat('S', cast(s_suppkey AS string)), s_suppkey, s_nationkey FROM supplier)
SELECT id_cnpj,
       CASE WHEN k % 2500 = 7 THEN NULL ELSE cast((k % 60 + 10) * 100000 + 1 AS double) END AS cd_cnae_prin,
       CASE WHEN k % 13 = 0 THEN NULL
            ELSE substring('ACALAMAPBACEDFESGOMAMGMSMTPAPBPEPIPRRJRNRORRRSSCSESPTO', cast(nk * 2 + 1 AS int), 2) END AS uf,
       CASE WHEN k % 250 = 3 THEN NULL ELSE cast(10 - k % 7 AS double) / 10 END AS sacado_indice_liquidez_1m,
       CASE WHEN k % 15 < 7 THEN NULL ELSE cast(k % 11 AS double) / 10 END AS cedente_indice_liquidez_1m,
       cast((k * 37) % 1001 AS double) AS score_materialidade_evolucao,
       cast((k % 7) * 2 AS double) AS media_atraso_dias,
       CASE WHEN k % 250 = 3 THEN NULL ELSE cast(k % 101 AS double) / 100 END AS indicador_liquidez_quantitativo_3m,
       cast(k % 7 AS double) / 10 AS share_vl_inad_pag_bol_6_a_15d,
       cast((k * 53) % 1001 AS double) AS score_quantidade_v2,
       cast((k * 71) % 1001 AS double) AS score_materialidade_v2
FROM c
"""

# The same tables as they could arrive: blanks around labels, unknown labels, missing
# payers, worthless receivables, due dates before the issue date, lower-case states.
_KEY = "cast(substring(id_boleto, 2) AS bigint)"
DIRTY_PAYMENTS_SQL = f"""
SELECT id_boleto,
       CASE WHEN {_KEY} % 503 = 9 THEN NULL ELSE id_pagador END AS id_pagador,
       id_beneficiario, dt_emissao,
       CASE WHEN {_KEY} % 307 = 11 THEN dt_emissao - 1 ELSE dt_vencimento END AS dt_vencimento,
       dt_pagamento,
       CASE WHEN {_KEY} % 211 = 3 THEN cast(0 AS double) ELSE vlr_nominal END AS vlr_nominal,
       CASE WHEN {_KEY} % 401 = 2 THEN NULL ELSE vlr_baixa END AS vlr_baixa,
       CASE WHEN {_KEY} % 40 = 0 THEN '  ' || tipo_baixa || ' '
            WHEN {_KEY} % 97 = 5 THEN '3 - Baixa desconhecida'
            WHEN {_KEY} % 97 = 6 THEN 'sem codigo' ELSE tipo_baixa END AS tipo_baixa,
       CASE WHEN {_KEY} % 50 = 1 THEN tipo_especie || ' ' ELSE tipo_especie END AS tipo_especie
FROM payments
"""
_COMPANY = "cast(substring(id_cnpj, 2) AS bigint)"
DIRTY_AUXILIARY_SQL = f"""
SELECT id_cnpj, cd_cnae_prin,
       CASE WHEN {_COMPANY} % 30 = 4 THEN ' ' || lower(uf) || ' ' ELSE uf END AS uf,
       CASE WHEN {_COMPANY} % 90 = 1 THEN cast(2 AS double) ELSE sacado_indice_liquidez_1m END AS sacado_indice_liquidez_1m,
       cedente_indice_liquidez_1m, score_materialidade_evolucao,
       CASE WHEN {_COMPANY} % 5 = 1 THEN NULL ELSE media_atraso_dias END AS media_atraso_dias,
       indicador_liquidez_quantitativo_3m, share_vl_inad_pag_bol_6_a_15d,
       score_quantidade_v2, score_materialidade_v2
FROM auxiliary
"""

# Dates and amounts as text, some of them unreadable or marked as missing.
TEXT_PAYMENTS_SQL = f"""
SELECT id_boleto,
       CASE WHEN {_KEY} % 31 = 1 THEN 'NA' WHEN {_KEY} % 31 = 2 THEN '2024-13-45'
            ELSE cast(dt_emissao AS string) END AS dt_emissao,
       CASE WHEN {_KEY} % 31 = 3 THEN 'amanha' ELSE cast(dt_vencimento AS string) END AS dt_vencimento,
       CASE WHEN dt_pagamento IS NULL THEN '' ELSE cast(dt_pagamento AS string) END AS dt_pagamento,
       CASE WHEN {_KEY} % 37 = 1 THEN 'n/a' WHEN {_KEY} % 37 = 2 THEN 'R$ 10'
            ELSE cast(vlr_nominal AS string) END AS vlr_nominal,
       CASE WHEN vlr_baixa IS NULL THEN 'null' ELSE cast(vlr_baixa AS string) END AS vlr_baixa
FROM payments
"""


@dataclass(frozen=True)
class Book:
    """All intermediate tables over one data folder, built on demand."""

    spark: SparkSession
    folder: str

    def _sql(self, text: str, **views: DataFrame) -> DataFrame:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(text)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def payments(self) -> DataFrame:
        return self._sql(PAYMENTS_SQL, orders=self.base("orders"), lineitem=self.base("lineitem"))

    @cached_property
    def stored_payments(self) -> DataFrame:
        """The payments written once, for tables that read them several times: each reading joins all lines and orders."""
        return stored(self.payments, "payments")

    @cached_property
    def raw_auxiliary(self) -> DataFrame:
        return self._sql(AUXILIARY_SQL, customer=self.base("customer"), supplier=self.base("supplier"))

    @cached_property
    def auxiliary(self) -> DataFrame:
        return cleaning.clean_auxiliary(self.raw_auxiliary)

    @cached_property
    def dirty_payments(self) -> DataFrame:
        return self._sql(DIRTY_PAYMENTS_SQL, payments=self.payments)

    @cached_property
    def dirty_auxiliary(self) -> DataFrame:
        return self._sql(DIRTY_AUXILIARY_SQL, auxiliary=self.raw_auxiliary)

    @cached_property
    def text_payments(self) -> DataFrame:
        return self._sql(TEXT_PAYMENTS_SQL, payments=self.payments)

    @cached_property
    def features(self) -> DataFrame:
        return features.build_features(
            cleaning.clean_payments(self.stored_payments), self.auxiliary, F.lit(AS_OF).cast("date")
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Scored by rules after cleaning, which makes every table deterministic."""
        return scoring.score_by_rules(self.stored_payments, self.auxiliary)

    @cached_property
    def raw_scored(self) -> DataFrame:
        return scoring.score_by_rules(self.stored_payments, self.raw_auxiliary)

    @cached_property
    def detail(self) -> DataFrame:
        return dashboard.with_display_columns(self.scored)

    @cached_property
    def beneficiaries(self) -> DataFrame:
        return portfolio.entity_risk(self.scored, contracts.BENEFICIARY)

    @cached_property
    def payers(self) -> DataFrame:
        return portfolio.entity_risk(self.scored, contracts.PAYER)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerting.make_alerts(self.beneficiaries)


# Day on which unpaid receivables are aged in the checked queries.
AS_OF = "2002-01-01"
