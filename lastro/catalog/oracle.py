"""The same results in plain SQL, for checking on a second engine.

Named intermediate tables are put in front of each statement as needed.  The SQL follows
the definitions row by row.  It shares the input views with the Spark plans, and the fixed values of the contracts:
column lists, allowed labels, lookup tables and null-rate thresholds.
"""

from __future__ import annotations

import re

from lastro import contracts
from lastro import fixed_values as fv
from lastro.catalog.views import (
    AS_OF, AUXILIARY_SQL, DIRTY_AUXILIARY_SQL, DIRTY_PAYMENTS_SQL, PAYMENTS_SQL, TEXT_PAYMENTS_SQL,
)

_ROLE_COLUMNS = ", ".join(
    f"{role.prefix}.{c} AS {role.prefix}_{c}"
    for role in contracts.ROLES for c in contracts.COMPANY_ATTRIBUTES
)
_ROLE_JOINS = " ".join(
    f"LEFT JOIN {{aux}} {role.prefix} ON p.{role.key} = {role.prefix}.id_cnpj" for role in contracts.ROLES
)
_DELAY = "cast(date_diff('day', dt_vencimento, dt_pagamento) AS integer)"


def _label(days: int) -> str:
    return f"cast(dt_pagamento IS NULL OR coalesce({_DELAY} > {days}, false) AS integer)"


def _quote(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _lookup(column: str, table: dict[str, str], default: str = "NULL") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {cases} ELSE {default} END"


def _band(column: str, scale: int = 1) -> str:
    low, high = (0.3, 0.6) if scale == 1 else (30, 60)
    return f"CASE WHEN {column} < {low} THEN 'low' WHEN {column} < {high} THEN 'medium' ELSE 'high' END"


def _division(column: str) -> str:
    return f"substring(lpad(cast(cast({column} AS bigint) AS varchar), 7, '0'), 1, 2)"


def _sector(division: str) -> str:
    return f"{_lookup(division, fv.CNAE_DIVISIONS, repr(fv.CNAE_DEFAULT_NAME))} || ' (CNAE ' || {division} || ')'"


def _money(column: str) -> str:
    return f"coalesce(cast(sum(cast({column} AS decimal(18,2))) AS double), 0)"


def _mean(column: str, digits: int = 2) -> str:
    return f"cast(sum(cast({column} AS decimal(18,{digits}))) AS double) / count({column})"


_SCORED = """
SELECT *, round_even(risk_score / 100, 4) AS default_probability,
       {band} AS risk_category
FROM (
  SELECT e.*, round_even(least(greatest(
           35 * CASE WHEN dmax = dmin THEN 0.0 ELSE coalesce((payer_media_atraso_dias - dmin) / (dmax - dmin), 0.0) END
         + 25 * least(greatest(coalesce(payer_share_vl_inad_pag_bol_6_a_15d, 0.0), 0.0), 1.0)
         + 20 * (1 - least(greatest(coalesce(payer_sacado_indice_liquidez_1m, med), 0.0), 1.0))
         + 20 * CASE WHEN mmax = mmin THEN 0.0
                     ELSE coalesce((payer_score_materialidade_evolucao - mmin) / (mmax - mmin), 0.0) END,
         0.0), 100.0), 1) AS risk_score
  FROM {enriched} e, (
    SELECT min(payer_media_atraso_dias) AS dmin, max(payer_media_atraso_dias) AS dmax,
           min(payer_score_materialidade_evolucao) AS mmin, max(payer_score_materialidade_evolucao) AS mmax,
           median(payer_sacado_indice_liquidez_1m) AS med FROM {enriched}) s) t
"""


def _entity(key: str, prefix: str) -> str:
    return f"""
SELECT {key}, count(id_boleto) AS total_boletos, round_even({_money('vlr_nominal')}, 2) AS total_value,
       round_even({_mean('vlr_nominal')}, 2) AS avg_boleto_value,
       cast(sum(is_defaulted) AS bigint) AS defaulted_boletos,
       round_even(avg(is_defaulted), 4) AS default_rate,
       round_even({_mean('default_probability', 4)}, 4) AS avg_default_probability,
       round_even({_mean('risk_score', 1)}, 2) AS avg_risk_score,
       round_even(max(risk_score), 2) AS max_risk_score,
       max({prefix}_uf) AS uf, max({prefix}_cd_cnae_prin) AS cd_cnae_prin,
       {_band(_mean('default_probability', 4))} AS risk_category
FROM scored WHERE {key} IS NOT NULL GROUP BY {key}"""


_TX_TEXT = (
    "lower(concat_ws(' ', coalesce(id_beneficiario, ''), coalesce(id_pagador, ''),"
    " coalesce(entity_uf, ''), coalesce(beneficiary_uf, ''), coalesce(payer_uf, ''),"
    " coalesce(cast(entity_sector AS varchar), ''), "
    f"coalesce({_sector(_division('entity_sector'))}, 'Setor CNAE -'), "
    f"{_lookup('risk_category', fv.RISK_DISPLAY)}))"
)

_ALERTS = """
SELECT 'Cedente' AS entity_type, id_pagador AS entity_id, uf, cd_cnae_prin AS sector, risk_category,
       avg_risk_score AS risk_score, cast(round_even(avg_risk_score * 10, 0) AS bigint) AS score_display,
       default_rate, total_value,
       CASE kind WHEN 1 THEN 'Score' WHEN 2 THEN 'Inadimplencia' ELSE 'Concentracao' END AS alert_type,
       CASE kind WHEN 1 THEN 'Critico' WHEN 2 THEN 'Alerta' ELSE 'Atencao' END AS level,
       CASE kind WHEN 2 THEN 'Em analise' ELSE 'Aberto' END AS status,
       CASE kind
         WHEN 1 THEN 'Score preditivo em ' || cast(cast(round_even(avg_risk_score * 10, 0) AS bigint) AS varchar)
              || '/1000 com exposicao de R$ ' || format('{:,}', cast(round_even(total_value, 0) AS bigint)) || '.'
         WHEN 2 THEN 'Inadimplencia observada de ' || cast(cast(round_even(default_rate * 100, 1) AS decimal(18,1)) AS varchar)
              || '% na entidade.'
         ELSE 'Entidade em alto risco com score ' || cast(cast(round_even(avg_risk_score * 10, 0) AS bigint) AS varchar)
              || '/1000.' END AS description
FROM (
  SELECT *, CASE WHEN avg_risk_score >= 75 THEN 1 WHEN default_rate >= 0.5 THEN 2 WHEN avg_risk_score >= 60 THEN 3 END AS kind
  FROM {entities}) k
WHERE kind IS NOT NULL"""

_SUMMARY = f"""count(*) AS total, {_money('vlr_nominal')} AS value,
       coalesce(count_if(is_defaulted = 1), 0) AS defaults,
       coalesce(cast(count_if(is_defaulted = 1) AS double) / nullif(count(*), 0), 0) AS default_rate,
       coalesce(cast(sum(cast(coalesce(score_display, 0) AS decimal(18,1))) AS double) / nullif(count(*), 0), 0) AS avg_score"""

# Intermediate tables, each using only tables before it.
TABLES = {
    "payments": PAYMENTS_SQL,
    "raw_auxiliary": AUXILIARY_SQL,
    "auxiliary": "SELECT * REPLACE (upper(trim(uf)) AS uf, cast(cd_cnae_prin AS bigint) AS cd_cnae_prin) FROM raw_auxiliary",
    "dirty_payments": DIRTY_PAYMENTS_SQL,
    "dirty_auxiliary": DIRTY_AUXILIARY_SQL.replace("FROM auxiliary", "FROM raw_auxiliary"),
    "text_payments": TEXT_PAYMENTS_SQL,
    "labelled": f"SELECT *, {_DELAY} AS payment_delay_days, {_label(0)} AS is_defaulted FROM payments",
    "enriched": f"SELECT p.*, {_ROLE_COLUMNS} FROM labelled p {_ROLE_JOINS.format(aux='auxiliary')}",
    "raw_enriched": f"SELECT p.*, {_ROLE_COLUMNS} FROM labelled p {_ROLE_JOINS.format(aux='raw_auxiliary')}",
    "scored": _SCORED.format(band=_band("risk_score", 100), enriched="enriched"),
    "raw_scored": _SCORED.format(band=_band("risk_score", 100), enriched="raw_enriched"),
    "detail": """SELECT *, strftime(dt_vencimento, '%Y-%m') AS due_year_month, strftime(dt_emissao, '%Y-%m') AS period_month,
       coalesce(beneficiary_uf, payer_uf) AS entity_uf,
       coalesce(beneficiary_cd_cnae_prin, payer_cd_cnae_prin) AS entity_sector,
       round_even(risk_score * 10, 0) AS score_display FROM scored""",
    "payer_risk": _entity("id_pagador", "payer"),
    "beneficiary_risk": _entity("id_beneficiario", "beneficiary"),
    "payer_alerts": _ALERTS.replace("{entities}", "payer_risk"),
    "temporal": f"""SELECT *, cast(date_diff('day', dt_emissao, dt_vencimento) AS integer) AS boleto_term_days,
       CASE WHEN dt_pagamento IS NULL THEN cast(date_diff('day', dt_vencimento, date '{AS_OF}') AS integer) ELSE 0 END AS days_overdue,
       cast(month(dt_vencimento) AS integer) AS due_month, cast(isodow(dt_vencimento) - 1 AS integer) AS due_day_of_week
       FROM enriched""",
    "payer_agg": f"""SELECT id_pagador, count(id_boleto) AS payer_boleto_count, avg(is_defaulted) AS payer_default_rate,
       {_mean('vlr_nominal')} AS payer_avg_nominal_value, avg(payment_delay_days) AS payer_avg_delay_days,
       max(payment_delay_days) AS payer_max_delay_days, avg(boleto_term_days) AS payer_avg_term_days
       FROM temporal GROUP BY id_pagador""",
    "beneficiary_agg": f"""SELECT id_beneficiario, count(id_boleto) AS beneficiary_boleto_count,
       avg(is_defaulted) AS beneficiary_default_rate, {_mean('vlr_nominal')} AS beneficiary_avg_nominal_value,
       {_money('vlr_nominal')} AS beneficiary_total_portfolio_value FROM temporal GROUP BY id_beneficiario""",
    "feature_table": """SELECT t.*, cast(nullif(regexp_extract(tipo_baixa, '^([0-9]+)', 1), '') AS bigint) AS settlement_code,
            pa.* EXCLUDE (id_pagador), ba.* EXCLUDE (id_beneficiario) FROM temporal t
            LEFT JOIN payer_agg pa ON t.id_pagador = pa.id_pagador
            LEFT JOIN beneficiary_agg ba ON t.id_beneficiario = ba.id_beneficiario""",
    "split": """SELECT *, CASE WHEN (cast(substring(id_boleto, 2) AS bigint) * 7919 + 42) % 1000 < 200
       THEN 'test' ELSE 'train' END AS split FROM temporal""",
    "hashed_split": """SELECT id_boleto, is_defaulted, CASE WHEN row_number() OVER (PARTITION BY is_defaulted ORDER BY md5('42:' || id_boleto))
       <= ceil(count(*) OVER (PARTITION BY is_defaulted) / 5.0) THEN 'test' ELSE 'train' END AS split FROM labelled""",
}


def with_tables(body: str) -> str:
    """The statement with every intermediate table it mentions, directly or through others."""
    needed: set[str] = set()

    def visit(text: str, names: list[str]) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|from|join|IN \(SELECT \w+ FROM) +{name}\b", text):
                needed.add(name)
                visit(TABLES[name], [n for n in names[: names.index(name)]])

    visit(body, list(TABLES))
    if not needed:
        return body
    parts = [f"{name} AS ({TABLES[name]})" for name in TABLES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _round4(expression: str) -> str:
    return f"round_even({expression}, 4)"


def _describe(series: str, value: str, source: str) -> str:
    return f"""SELECT '{series}' AS series, count({value}) AS count, {_round4(f'avg({value})')} AS mean,
       {_round4(f'stddev_samp({value})')} AS std, {_round4(f'min(cast({value} AS double))')} AS min,
       {_round4(f'quantile_cont(cast({value} AS double), 0.25)')} AS p25,
       {_round4(f'quantile_cont(cast({value} AS double), 0.5)')} AS p50,
       {_round4(f'quantile_cont(cast({value} AS double), 0.75)')} AS p75,
       {_round4(f'max(cast({value} AS double))')} AS max FROM {source}"""


def _segment(attribute: str, name: str, source: str, rounded: bool) -> str:
    def shown(expression: str, digits: int) -> str:
        return f"round_even({expression}, {digits})" if rounded else expression

    parts = []
    for role in contracts.ROLES:
        key = f"{role.prefix}_{attribute}"
        where = f"WHERE {key} IS NOT NULL" if rounded else ""
        parts.append(f"""SELECT '{role.prefix}' AS perspective, {key} AS {name}, count(id_boleto) AS total_boletos,
       {shown(_money('vlr_nominal'), 2)} AS total_value, cast(sum(is_defaulted) AS bigint) AS defaulted_boletos,
       {shown('avg(is_defaulted)', 4)} AS default_rate, {shown(_mean('risk_score', 1), 2)} AS avg_risk_score,
       {shown(_mean('default_probability', 4), 4)} AS avg_default_probability
       FROM {source} {where} GROUP BY {key}""")
    return " UNION ALL ".join(parts)


def _temporal(source: str, rounded: bool) -> str:
    def shown(expression: str, digits: int) -> str:
        return f"round_even({expression}, {digits})" if rounded else expression

    return f"""SELECT strftime(dt_vencimento, '%Y-%m') AS due_year_month, count(id_boleto) AS total_boletos,
       {shown(_money('vlr_nominal'), 2)} AS total_value, cast(sum(is_defaulted) AS bigint) AS defaulted_boletos,
       {shown('avg(is_defaulted)', 4)} AS default_rate, {shown(_mean('risk_score', 1), 2)} AS avg_risk_score,
       {shown(_mean('default_probability', 4), 4)} AS avg_default_probability,
       count_if(risk_category = 'high') AS high_risk_count
       FROM {source} GROUP BY 1"""


def _distribution(source: str, from_raw: bool) -> str:
    # ceil(p * 10) - 1 on probabilities of four decimals, in whole ten-thousandths.
    value = "coalesce(default_probability, 0)" if from_raw else "default_probability"
    tenth = f"cast(greatest((cast(round({value} * 10000) AS bigint) + 999) // 1000 - 1, 0) AS integer)"
    rate, total = "avg(is_defaulted)", _money("vlr_nominal")
    share = ""
    if not from_raw:
        rate, total = f"round_even({rate}, 4)", f"round_even({total}, 2)"
        share = f", round_even(cast(count(id_boleto) AS double) / (SELECT count(*) FROM {source}), 4) AS pct_of_portfolio"
    return f"""SELECT cast(b * 10 AS varchar) || '-' || cast(b * 10 + 10 AS varchar) || '%' AS probability_bucket,
       b AS bucket_idx, count(id_boleto) AS boleto_count, cast(sum(is_defaulted) AS bigint) AS actual_default_count,
       {rate} AS actual_default_rate, {total} AS total_value {share}
       FROM (SELECT *, {tenth} AS b FROM {source}) d GROUP BY b"""


def _overview(source: str, full: bool) -> str:
    rates = "".join(
        f", round_even(avg(cast(risk_category = '{b}' AS integer)), 4) AS {b}_risk_rate"
        for b in ("high", "medium", "low")
    )
    extra = f""", count_if(is_defaulted = 0) AS non_defaulted_boletos,
       {_money("CASE WHEN is_defaulted = 1 THEN vlr_nominal END")} AS defaulted_portfolio_value,
       {_money("CASE WHEN is_defaulted = 0 THEN vlr_nominal END")} AS non_defaulted_value {rates}""" if full else ""
    return f"""SELECT count(*) AS total_boletos, cast(sum(is_defaulted) AS bigint) AS defaulted_boletos,
       round_even(avg(is_defaulted), 4) AS default_rate, {_money('vlr_nominal')} AS total_portfolio_value,
       round_even({_mean('vlr_nominal')}, 2) AS avg_boleto_value,
       round_even({_mean('risk_score', 1)}, 2) AS avg_risk_score,
       count_if(risk_category = 'high') AS high_risk_count, count_if(risk_category = 'medium') AS medium_risk_count,
       count_if(risk_category = 'low') AS low_risk_count {extra} FROM {source}"""


def _null_cells(table: str, dataset: str, columns, shape: str) -> str:
    return " UNION ALL ".join(shape.format(d=dataset, c=c, t=table) for c in columns)


def _top_nulls(table: str, dataset: str, columns) -> str:
    cells = _null_cells(
        table, dataset, columns,
        "SELECT '{d}' AS dataset, '{c}' AS \"column\", avg(cast({c} IS NULL AS integer)) AS rate FROM {t}",
    )
    return f"""SELECT dataset, "column", round_even(rate, 4) AS rate FROM (
       SELECT * FROM ({cells}) c ORDER BY rate DESC, "column" LIMIT 5) t"""


def _dq_row(dataset, check, column, severity, observed, threshold, table) -> str:
    name = f"'{column}'" if column else "cast(NULL AS varchar)"
    return (
        f"SELECT '{dataset}' AS dataset, '{check}' AS \"check\", {name} AS \"column\", '{severity}' AS severity, "
        f"cast({observed} AS double) AS observed, cast({threshold!r} AS double) AS threshold FROM {table}"
    )


def _rules() -> dict[str, str]:
    code = "regexp_extract(tipo_baixa, '^([0-9]+)', 1)"
    silent = f"(tipo_baixa IS NULL OR {code} IN ({_quote(fv.NON_FINANCIAL_CODES)}))"
    return {
        "tipo_baixa / dt_pagamento": "count_if((tipo_baixa IS NULL) <> (dt_pagamento IS NULL))",
        "vlr_baixa / tipo_baixa": f"count_if(vlr_baixa IS NULL AND NOT {silent}) + count_if(vlr_baixa IS NOT NULL AND {silent})",
        "dt_emissao / dt_vencimento": "count_if(dt_emissao > dt_vencimento)",
    }


def _dq(dataset: str, contract, table: str) -> str:
    rows = [_dq_row(dataset, "columns", None, "error", "0", 0.0, "(SELECT 1) one")]
    for name, spec in contract.items():
        if not spec.nullable:
            rows.append(_dq_row(dataset, "nullable", name, "error", f"count_if({name} IS NULL)", 0.0, table))
        bounds = []
        if spec.min_value is not None:
            bounds.append(f"count_if({name} < {spec.min_value!r})")
        if spec.max_value is not None:
            bounds.append(f"count_if({name} > {spec.max_value!r})")
        if bounds:
            rows.append(_dq_row(dataset, "range", name, "error", " + ".join(bounds), 0.0, table))
        if spec.nullable and spec.baseline_null_rate:
            rate = f"avg(cast({name} IS NULL AS integer))"
            rows.append(_dq_row(dataset, "null_rate", name, "warning", rate, spec.null_rate_threshold(), table))
        if spec.unique:
            extra = f"count(*) - count(DISTINCT {name}) - cast(count({name}) < count(*) AS integer)"
            rows.append(_dq_row(dataset, "unique", name, "error", extra, 0.0, table))
        if spec.allowed:
            bad = f"count(DISTINCT CASE WHEN {name} NOT IN ({_quote(spec.allowed)}) THEN {name} END)"
            rows.append(_dq_row(dataset, "allowed_values", name, "error", bad, 0.0, table))
    if contract is contracts.PAYMENTS:
        for name, broken in _rules().items():
            rows.append(_dq_row(dataset, "business_rule", name, "error", broken, 0.0, table))
    inner = " UNION ALL ".join(rows)
    return f"SELECT *, observed <= threshold AS passed FROM ({inner}) r"


def _allowed(contract, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", {n} AS value, count(*) AS rows FROM {table} "
        f"WHERE {n} NOT IN ({_quote(s.allowed)}) GROUP BY {n}"
        for n, s in contract.items() if s.allowed
    )


def _json_dates(columns: str) -> str:
    return ", ".join(
        f"strftime({c}, '%Y-%m-%d') AS {c}" if c.startswith("dt_") else c for c in columns.split()
    )


def _median_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS series, quantile_cont(cast({c} AS double), 0.5) AS median FROM split WHERE split = 'train'"
        for c in contracts.NUMERIC_FEATURES
    )


def _code_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", value, cast(row_number() OVER (ORDER BY value) - 1 AS double) AS code FROM "
        f"(SELECT DISTINCT coalesce(cast({c} AS varchar), 'UNKNOWN') AS value FROM split WHERE split = 'train') v"
        for c in contracts.CATEGORICAL_FEATURES
    )


def _audit_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) <= 1 AS zero_variance, count_if({c} IS NULL) AS nulls FROM split"
        for c in contracts.SAFE_FEATURES
    )


_PERIOD = "dt_emissao >= date '1998-03-01' AND dt_emissao < date '1998-04-01'"
_RJ = "(entity_uf = 'RJ' OR beneficiary_uf = 'RJ' OR payer_uf = 'RJ')"
_TX_COLUMNS = "id_boleto, period_month, entity_uf, entity_sector, risk_category"
# Tables of fitted values, and scores of the model of given coefficients.
TABLES["medians"] = _median_rows()
TABLES["codes"] = _code_rows()


def _model_input(column: str) -> str:
    if column in contracts.NUMERIC_FEATURES:
        return f"coalesce(cast(s.{column} AS double), (SELECT median FROM medians WHERE series = '{column}'))"
    return f"coalesce(code_{column}.code, -1)"


def _given_margin() -> str:
    terms = [f"{_model_input(c)} * {GIVEN_COEFFICIENTS[c]!r}" for c in contracts.SAFE_FEATURES]
    return " + ".join([repr(GIVEN_INTERCEPT), *terms])


def _code_joins() -> str:
    return " ".join(
        f"LEFT JOIN codes code_{c} ON code_{c}.\"column\" = '{c}' AND code_{c}.value = coalesce(cast(s.{c} AS varchar), 'UNKNOWN')"
        for c in contracts.CATEGORICAL_FEATURES
    )


# One millionth for the value, -5 to 5 five-thousandths for the others, in turn.
GIVEN_INTERCEPT = 0.1
GIVEN_COEFFICIENTS = {
    c: 1e-6 if c == "vlr_nominal" else ((i * 7) % 11 - 5) / 5000 for i, c in enumerate(contracts.SAFE_FEATURES)
}
TABLES["given"] = f"SELECT s.*, 1 / (1 + exp(-({_given_margin()}))) AS probability FROM split s {_code_joins()}"
TABLES["scored_given"] = f"""SELECT {', '.join((*contracts.IDENTIFIERS, *contracts.DATES, contracts.TARGET, *contracts.SCORE_CONTEXT))},
       round_even(probability, 4) AS default_probability, round_even(probability * 100, 1) AS risk_score,
       {_band('round_even(probability, 4)')} AS risk_category FROM given"""

_FEATURES = ", ".join(("id_boleto", "is_defaulted", *contracts.SAFE_FEATURES))
_PAIRS = """SELECT sum(pos * (n_before + neg / 2.0)) / (max(all_pos) * max(all_neg)) AS auc_roc,
       sum(pos * (cast(p_above AS double) / (p_above + n_above))) / max(all_pos) AS auc_pr
  FROM (SELECT default_probability AS x, pos, neg,
          coalesce(sum(neg) OVER (ORDER BY default_probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before,
          sum(pos) OVER (ORDER BY default_probability DESC) AS p_above,
          sum(neg) OVER (ORDER BY default_probability DESC) AS n_above,
          sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
        FROM (SELECT default_probability, cast(sum(is_defaulted) AS double) AS pos,
                cast(sum(1 - is_defaulted) AS double) AS neg FROM scored GROUP BY default_probability) g) r"""
_CONFUSION = """SELECT 'rules' AS series, count_if(is_defaulted = 0 AND default_probability < 0.5) AS tn,
       count_if(is_defaulted = 0 AND default_probability >= 0.5) AS fp,
       count_if(is_defaulted = 1 AND default_probability < 0.5) AS fn,
       count_if(is_defaulted = 1 AND default_probability >= 0.5) AS tp FROM scored"""
_FLAGS = "SELECT is_defaulted, count(*) AS rows, count(payment_delay_days) AS paid FROM ({}) t GROUP BY is_defaulted"


def _match(role: contracts.Role) -> str:
    known = f"{role.key} IN (SELECT id_cnpj FROM raw_auxiliary)"
    matched = f"count_if(coalesce({known}, false))"
    return f"""SELECT '{role.prefix}' AS role, cast(count(*) AS bigint) AS rows, cast({matched} AS bigint) AS matched,
       cast({matched} AS double) / count(*) AS match_rate,
       cast({matched} AS double) / count(*) < 1.0 - 0.01 AS below_expected FROM dirty_payments"""


def _statements() -> dict[str, str]:
    pay, aux = contracts.PAYMENTS, contracts.AUXILIARY
    return {
        "scan_payments": """SELECT * REPLACE ('a "b", ' || tipo_especie || chr(10) || '"' AS tipo_especie) FROM payments""",
        "scan_auxiliary": """SELECT * REPLACE ('a "b", ' || uf || chr(10) || '"' AS uf) FROM raw_auxiliary""",
        "coerce_types": """SELECT id_boleto, try_cast(dt_emissao AS date) AS dt_emissao, try_cast(dt_vencimento AS date) AS dt_vencimento,
            try_cast(dt_pagamento AS date) AS dt_pagamento, try_cast(vlr_nominal AS double) AS vlr_nominal,
            try_cast(vlr_baixa AS double) AS vlr_baixa FROM text_payments""",
        "dq_report": _dq("payments", pay, "dirty_payments") + " UNION ALL " + _dq("auxiliary", aux, "dirty_auxiliary"),
        "dq_summary": f"""SELECT dataset, bool_and(passed OR severity = 'warning') AS passed,
            count_if(NOT passed AND severity = 'error') AS errors, count_if(NOT passed AND severity = 'warning') AS warnings
            FROM ({_dq("payments", pay, "dirty_payments")} UNION ALL {_dq("auxiliary", aux, "raw_auxiliary")}) d GROUP BY dataset""",
        "dq_unique": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", cast(count(*) - count(DISTINCT {c}) AS bigint) AS duplicates FROM lineitem"
            for c in ("l_orderkey", "l_partkey", "l_suppkey")
        ),
        "dq_allowed": _allowed(pay, "dirty_payments") + " UNION ALL " + _allowed(aux, "dirty_auxiliary"),
        "dq_null_rate": " UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", round_even(avg(cast({n} IS NULL AS integer)), 6) AS observed, "
            f"cast({s.null_rate_threshold()!r} AS double) AS threshold, "
            f"avg(cast({n} IS NULL AS integer)) <= {s.null_rate_threshold()!r} AS passed FROM dirty_auxiliary"
            for n, s in aux.items() if s.nullable and s.baseline_null_rate
        ),
        "dq_business_rules": " UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", cast({b} AS double) AS observed, {b} = 0 AS passed FROM dirty_payments"
            for n, b in _rules().items()
        ),
        "join_match_rate": " UNION ALL ".join(_match(r) for r in contracts.ROLES),
        "null_rate_top5": _top_nulls("payments", "payments", pay) + " UNION ALL " + _top_nulls("raw_auxiliary", "auxiliary", aux),
        "null_counts": " UNION ALL ".join(
            _null_cells(t, d, c, "SELECT '{d}' AS dataset, '{c}' AS \"column\", count_if({c} IS NULL) AS nulls FROM {t}")
            for t, d, c in (("payments", "payments", pay), ("raw_auxiliary", "auxiliary", aux))
        ),
        "clean_payments": """SELECT id_boleto, trim(tipo_baixa) AS tipo_baixa, trim(tipo_especie) AS tipo_especie,
            try_cast(nullif(regexp_extract(trim(tipo_baixa), '^([0-9]+)', 1), '') AS bigint) AS settlement_code FROM dirty_payments""",
        "clean_auxiliary": "SELECT id_cnpj, upper(trim(uf)) AS uf, cast(cd_cnae_prin AS bigint) AS cd_cnae_prin FROM dirty_auxiliary",
        "dedup_keep_last": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, removed FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn,
              count(*) OVER (PARTITION BY l_orderkey) - 1 AS removed FROM lineitem) t WHERE rn = 1""",
        "enrich_payer": "SELECT p.*, " + ", ".join(
            f"a.{c} AS payer_{c}" for c in contracts.COMPANY_ATTRIBUTES
        ) + " FROM payments p LEFT JOIN auxiliary a ON p.id_pagador = a.id_cnpj",
        "enrich": "SELECT * EXCLUDE (payment_delay_days, is_defaulted) FROM enriched",
        "enrich_split_keys": "SELECT * EXCLUDE (payment_delay_days, is_defaulted) FROM enriched",
        "temporal_features": """SELECT id_boleto, boleto_term_days, payment_delay_days, days_overdue, is_defaulted, due_month,
            due_day_of_week FROM temporal""",
        "default_flag": _FLAGS.format("SELECT * FROM labelled"),
        "default_flag_5d": _FLAGS.format(
            f"SELECT * REPLACE ({_label(5)} AS is_defaulted) FROM labelled"
        ),
        "payer_features": "SELECT id_boleto, a.* EXCLUDE (id_pagador) FROM payments p LEFT JOIN payer_agg a ON p.id_pagador = a.id_pagador",
        "beneficiary_features": "SELECT id_boleto, a.* EXCLUDE (id_beneficiario) FROM payments p LEFT JOIN beneficiary_agg a ON p.id_beneficiario = a.id_beneficiario",
        "payments_features": "SELECT * FROM feature_table",
        "leakage_audit": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", true AS present, count({c}) AS values FROM feature_table" for c in contracts.LEAKY
        ),
        "settlement_mix": f"""SELECT tipo_baixa, count(*) AS count,
            {_lookup("substring(tipo_baixa, 1, 1)", fv.SETTLEMENT_MEANING)} AS meaning FROM payments GROUP BY tipo_baixa""",
        "cnae_division": f"""SELECT id_cnpj, {_division('cd_cnae_prin')} AS division,
            {_sector(_division('cd_cnae_prin'))} AS label FROM raw_auxiliary""",
        "minmax_normalize": """SELECT id_cnpj, round_even((score_materialidade_evolucao - mn) / (mx - mn), 8) AS normalized
            FROM raw_auxiliary, (SELECT min(score_materialidade_evolucao) AS mn, max(score_materialidade_evolucao) AS mx FROM raw_auxiliary) e""",
        "heuristic_score": "SELECT id_boleto, is_defaulted, risk_score, default_probability, risk_category FROM raw_scored",
        "risk_category": f"""SELECT id_cnpj, round_even(score_quantidade_v2 / 1001, 4) AS default_probability,
            round_even(score_quantidade_v2 / 1001 * 100, 1) AS risk_score,
            {_band("round_even(score_quantidade_v2 / 1001, 4)")} AS risk_category,
            {_band("score_quantidade_v2 / 10", 100)} AS band_of_score,
            {_band("cedente_indice_liquidez_1m")} AS band_with_gaps FROM raw_auxiliary""",
        "categorical_unknown": "SELECT coalesce(uf, 'UNKNOWN') AS uf, count(*) AS companies FROM auxiliary GROUP BY 1",
        "portfolio_overview": _overview("scored", True),
        "payer_risk": "SELECT * FROM payer_risk",
        "beneficiary_risk": "SELECT * FROM beneficiary_risk",
        "temporal_analysis": _temporal("scored", True),
        "uf_analysis": _segment("uf", "uf", "scored", True),
        "cnae_analysis": _segment("cd_cnae_prin", "cd_cnae", "scored", True),
        "score_distribution": _distribution("scored", False),
        "entity_risk_fallback": f"""SELECT id_pagador, count(id_boleto) AS total_boletos, {_money('vlr_nominal')} AS total_value,
            {_mean('vlr_nominal')} AS avg_boleto_value, cast(sum(is_defaulted) AS bigint) AS defaulted_boletos,
            avg(is_defaulted) AS default_rate, {_mean('default_probability', 4)} AS avg_default_probability,
            {_mean('risk_score', 1)} AS avg_risk_score, max(risk_score) AS max_risk_score, max(payer_uf) AS uf,
            max(payer_cd_cnae_prin) AS cd_cnae_prin, {_band(_mean('risk_score', 1), 100)} AS risk_category
            FROM raw_scored GROUP BY id_pagador""",
        "segment_fallback": _segment("uf", "uf", "raw_scored", False),
        "cnae_fallback": _segment("cd_cnae_prin", "cd_cnae", "raw_scored", False),
        "temporal_fallback": _temporal("raw_scored", False),
        "score_distribution_fallback": _distribution("raw_scored", True),
        "portfolio_fallback": _overview("raw_scored", False),
        "risk_counts": "SELECT risk_category, count(*) AS count FROM scored GROUP BY risk_category",
        "transaction_detail": """SELECT id_boleto, dt_pagamento, vlr_baixa, tipo_baixa, tipo_especie, payment_delay_days,
            beneficiary_media_atraso_dias, payer_media_atraso_dias, due_year_month, period_month, entity_uf, entity_sector,
            score_display FROM detail""",
        "compact_transactions": "SELECT " + _json_dates("""dt_emissao dt_vencimento dt_pagamento vlr_nominal vlr_baixa is_defaulted
            payer_uf beneficiary_uf payer_cd_cnae_prin beneficiary_cd_cnae_prin payment_delay_days beneficiary_media_atraso_dias
            beneficiary_cedente_indice_liquidez_1m beneficiary_share_vl_inad_pag_bol_6_a_15d default_probability risk_score
            risk_category period_month due_year_month entity_uf entity_sector score_display""") + """,
            id_pagador, id_beneficiario, tipo_baixa, substring(id_pagador, 1, 12) AS id_pagador_short,
            substring(id_beneficiario, 1, 12) AS id_beneficiario_short,
            substring(coalesce(tipo_baixa, ''), 1, 54) AS tipo_baixa_short FROM detail""",
        "export_records": """SELECT *, substring(id_pagador, 1, 12) AS id_pagador_short, round_even(avg_risk_score * 10, 0) AS score_display
            FROM payer_risk""",
        "filter_transactions": f"""SELECT {_TX_COLUMNS} FROM detail WHERE {_PERIOD} AND {_RJ} AND contains({_TX_TEXT}, 'comercio')
            UNION ALL SELECT {_TX_COLUMNS} FROM detail WHERE (
              {' OR '.join(f"{_division(c)} = '46'" for c in ('entity_sector', 'beneficiary_cd_cnae_prin', 'payer_cd_cnae_prin'))})
              AND contains({_TX_TEXT}, 'alto')""",
        "filtered_kpis": f"""SELECT {_SUMMARY}, count(DISTINCT nullif(id_beneficiario, '')) AS beneficiaries FROM detail
            WHERE {_RJ} AND contains({_TX_TEXT}, 'comercio')""",
        "filtered_segments": f"""SELECT CASE WHEN d = '-' THEN 'Setor CNAE -' ELSE {_sector('d')} END AS segment, value, default_rate,
            liquidity, avg_score AS score FROM (
              SELECT d, {_SUMMARY}, round_even(avg(coalesce(beneficiary_cedente_indice_liquidez_1m, 0)), 6) AS liquidity
              FROM (SELECT *, coalesce({_division('entity_sector')}, '-') AS d FROM detail
                WHERE {_RJ} AND contains({_TX_TEXT}, 'comercio')) x GROUP BY d ORDER BY value DESC, d LIMIT 8) t""",
        "filtered_months": f"""SELECT month, avg_score, default_rate FROM (
            SELECT period_month AS month, {_SUMMARY} FROM detail WHERE period_month IS NOT NULL AND {_RJ}
              AND contains({_TX_TEXT}, 'comercio') GROUP BY period_month ORDER BY 1 DESC LIMIT 12) t""",
        "filtered_beneficiaries": f"""SELECT id_beneficiario, uf, cd_cnae_prin, total_value, avg_risk_score FROM beneficiary_risk
            WHERE uf = 'RJ' AND id_beneficiario IN (SELECT id_beneficiario FROM detail WHERE {_PERIOD} AND {_RJ})""",
        "filtered_alerts": f"""SELECT entity_id, uf, alert_type, level, risk_score FROM payer_alerts
            WHERE level = 'Critico' AND entity_id IN (SELECT id_pagador FROM detail WHERE {_PERIOD})
              AND contains(lower(concat_ws(' ', entity_id, alert_type, description, coalesce(uf, ''))), 'score')""",
        "dashboard_kpis": f"SELECT {_SUMMARY}, count(DISTINCT nullif(id_beneficiario, '')) AS beneficiaries FROM detail",
        "default_rate_by_issue_month": f"""SELECT month, avg_score, default_rate FROM (
            SELECT period_month AS month, {_SUMMARY} FROM detail WHERE period_month IS NOT NULL
            GROUP BY period_month ORDER BY 1 DESC LIMIT 12) t""",
        "value_by_risk": f"SELECT risk_category AS risk, {_money('vlr_nominal')} AS value FROM detail GROUP BY risk_category",
        "segment_top8": f"""SELECT CASE WHEN d = '-' THEN 'Setor CNAE -' ELSE {_sector('d')} END AS segment, value, default_rate,
            liquidity, avg_score AS score FROM (
              SELECT d, {_SUMMARY}, round_even(avg(coalesce(beneficiary_cedente_indice_liquidez_1m, 0)), 6) AS liquidity
              FROM (SELECT *, coalesce({_division('entity_sector')}, '-') AS d FROM detail) x GROUP BY d
              ORDER BY value DESC, d LIMIT 8) t""",
        "beneficiary_delay_by_month": """SELECT period_month AS month, avg(coalesce(payment_delay_days, 0)) AS delay FROM detail
            WHERE id_beneficiario = 'S7' AND period_month IS NOT NULL GROUP BY period_month ORDER BY 1 DESC LIMIT 12""",
        "beneficiary_drilldown": """SELECT id_boleto, dt_emissao, dt_vencimento, dt_pagamento, vlr_baixa, tipo_baixa FROM detail
            WHERE id_beneficiario = 'S7'""",
        "beneficiary_first_rows": """SELECT dt_emissao, dt_vencimento, dt_pagamento, vlr_baixa, tipo_baixa FROM detail
            WHERE id_beneficiario = 'S7'""",
        "beneficiary_kpis": f"""SELECT id_beneficiario, {_SUMMARY}, avg(coalesce(payment_delay_days, 0)) AS delay,
            round_even(avg(coalesce(beneficiary_cedente_indice_liquidez_1m, 0)), 6) AS liquidity
            FROM detail GROUP BY id_beneficiario""",
        "export_sectors": f"""SELECT * FROM ({_segment("cd_cnae_prin", "cd_cnae", "scored", True)}) s
            """,
        "aging_buckets": " UNION ALL ".join(
            f"SELECT id_beneficiario, '{n}' AS bucket, count_if({c}) AS count FROM detail GROUP BY id_beneficiario"
            for n, c in zip(fv.AGING_LABELS, (
                "coalesce(payment_delay_days, 0) <= 0 AND is_defaulted = 0",
                "coalesce(payment_delay_days, 0) BETWEEN 1 AND 15",
                "coalesce(payment_delay_days, 0) BETWEEN 16 AND 60",
                "coalesce(payment_delay_days, 0) > 60",
                "dt_pagamento IS NULL",
            ))
        ),
        "high_risk_recall": """SELECT count_if(is_defaulted = 1 AND risk_category = 'high') AS caught,
            count_if(is_defaulted = 1) AS defaulted,
            cast(count_if(is_defaulted = 1 AND risk_category = 'high') AS double) / greatest(1, count_if(is_defaulted = 1)) AS recall
            FROM detail""",
        "facets": f"""SELECT DISTINCT 'period' AS facet, period_month AS value, period_month AS label FROM detail WHERE period_month IS NOT NULL
            UNION ALL SELECT DISTINCT 'uf', entity_uf, entity_uf FROM detail WHERE entity_uf IS NOT NULL
            UNION ALL SELECT DISTINCT 'sector', {_division('entity_sector')}, {_sector(_division('entity_sector'))} FROM detail
              WHERE entity_sector IS NOT NULL""",
        "alerts_beneficiaries": _ALERTS.replace("{entities}", "beneficiary_risk").replace("id_pagador", "id_beneficiario"),
        "alerts_payers": "SELECT * FROM payer_alerts",
        "alert_counts": """SELECT count(*) AS alerts, count_if(level = 'Critico') AS critical,
            count_if(alert_type = 'Score') AS score_alerts, count_if(alert_type <> 'Score') AS operational FROM payer_alerts""",
        "alert_types": "SELECT alert_type, count(*) AS count FROM payer_alerts GROUP BY alert_type",
        "priority_queue": """SELECT * FROM payer_risk""",
        "default_rate_by_uf": f"""SELECT payer_uf AS uf, round_even(avg({_label(5)}), 6) AS default_rate
            FROM enriched WHERE payer_uf IS NOT NULL GROUP BY payer_uf""",
        "describe_value": _describe("vlr_nominal", "vlr_nominal", "payments"),
        "describe_delay": _describe("dias_atraso", _DELAY, "payments"),
        "delay_histogram": """SELECT cast(b.range AS integer) AS bin, count(x) AS count FROM range(50) b LEFT JOIN (
              SELECT payment_delay_days AS x, least(floor((payment_delay_days - mn) * 50.0 / (mx - mn)), 49) AS bin FROM labelled,
                (SELECT min(payment_delay_days) AS mn, max(payment_delay_days) AS mx FROM labelled) e
              WHERE payment_delay_days IS NOT NULL) h ON b.range = h.bin GROUP BY b.range""",
        "payer_frequency": " UNION ALL ".join(
            _describe(k, "n", f"(SELECT {k}, count(*) AS n FROM payments GROUP BY {k}) f") for k in ("id_pagador", "id_beneficiario")
        ),
        "monthly_volume": "SELECT strftime(dt_vencimento, '%Y-%m') AS due_year_month, count(*) AS count FROM payments GROUP BY 1",
        "value_by_default_flag": " UNION ALL ".join(
            _describe(n, "vlr_nominal", f"(SELECT vlr_nominal FROM payments WHERE {_label(5)} = {v}) f")
            for n, v in (("false", 0), ("true", 1))
        ),
        "top10_value": "SELECT id_boleto, vlr_nominal FROM payments ORDER BY vlr_nominal DESC, id_boleto LIMIT 10",
        "ml_features": f"SELECT {_FEATURES} FROM temporal",
        "ml_split": "SELECT id_boleto, is_defaulted, split FROM split",
        "ml_audit": """SELECT split, count(*) AS rows, cast(sum(is_defaulted) AS bigint) AS defaulted,
            round_even(avg(is_defaulted), 6) AS default_rate,
            round_even((1 - avg(is_defaulted)) / avg(is_defaulted), 6) AS imbalance FROM split GROUP BY split""",
        "stratified_split": """SELECT split, count(*) AS rows, cast(sum(is_defaulted) AS bigint) AS defaulted, avg(is_defaulted) AS default_rate,
            (1 - avg(is_defaulted)) / nullif(avg(is_defaulted), 0) AS imbalance FROM hashed_split GROUP BY split""",
        "stratified_split_rows": "SELECT id_boleto, is_defaulted, split FROM hashed_split",
        "score_dataset_given": "SELECT * FROM scored_given",
        "model_overview_given": _overview("scored_given", True),
        "model_metrics_given": """SELECT 'given' AS model, round_even(auc, 4) AS auc_roc,
            round_even(2.0 * tp / (2.0 * tp + fp + fn), 4) AS f1, tn, fp, fn, tp
            FROM (SELECT count_if(is_defaulted = 0 AND probability <= 0.5) AS tn, count_if(is_defaulted = 0 AND probability > 0.5) AS fp,
                count_if(is_defaulted = 1 AND probability <= 0.5) AS fn, count_if(is_defaulted = 1 AND probability > 0.5) AS tp
                FROM given WHERE split = 'test') c,
              (SELECT sum(CASE WHEN is_defaulted = 1 THEN place ELSE 0 END) AS s, count_if(is_defaulted = 1) AS p,
                count_if(is_defaulted = 0) AS n, (s - p * (p + 1) / 2) / (cast(p AS double) * n) AS auc FROM (
                SELECT is_defaulted, (2.0 * rank() OVER (ORDER BY probability) + count(*) OVER (PARTITION BY probability) - 1) / 2 AS place
                FROM given WHERE split = 'test') r) a""",
        "feature_audit": _audit_rows(),
        "impute_median": _median_rows(),
        "quantiles_bucketed": _median_rows(),
        "encode_ordinal": _code_rows(),
        "class_weights": """SELECT is_defaulted AS label, count(*) AS rows,
            cast((SELECT count(*) FROM labelled) AS double) / (2 * count(*)) AS balanced_weight,
            (SELECT cast(count_if(is_defaulted = 0) AS double) / greatest(count_if(is_defaulted = 1), 1) FROM labelled) AS negative_to_positive
            FROM labelled GROUP BY is_defaulted""",
        "auc_roc": f"SELECT 'rules' AS series, round_even(auc_roc, 8) AS auc_roc FROM ({_PAIRS}) m",
        "auc_pr": f"SELECT 'rules' AS series, round_even(auc_pr, 8) AS auc_pr FROM ({_PAIRS}) m",
        "confusion_matrix": _CONFUSION,
        "f1_score": f"SELECT series, round_even(2.0 * tp / (2.0 * tp + fp + fn), 8) AS f1 FROM ({_CONFUSION}) c",
    }


def oracle_statements() -> dict[str, str]:
    return {name: with_tables(body) for name, body in _statements().items()}
