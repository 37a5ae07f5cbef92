"""Data-contract checks as a report table.

All counting checks of a table share one aggregation pass.  Repeated keys and
unexpected labels need a grouping of their own; both are grouped by value before anything
is counted, so a frequent value is reduced in the map tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastro import fixed_values as fv
from lastro.contracts import PAYMENTS, ColumnSpec
from lastro.functions.literals import in_list, name, quoted
from lastro.session import stored
from lastro.functions.measures import round_even

Contract = dict[str, ColumnSpec]
ERROR, WARNING = "error", "warning"
SHOWN_VALUES = 100

REPORT = (
    "dataset", "check", "column", "severity", "passed", "observed", "threshold", "message", "detail",
)


def _present(df: DataFrame, contract: Contract) -> Contract:
    columns = set(df.columns)
    return {name: spec for name, spec in contract.items() if name in columns}


class _Pass:
    """Collects aggregates, as SQL text, and the report rows that read them."""

    def __init__(self) -> None:
        self.measures: list[str] = []
        self.rows: list[str] = []

    def add(self, check: str, column: str, severity: str, limit: float, **parts: str) -> None:
        """A check whose observed value is the sum of its named parts."""
        names = {}
        for part, measure in parts.items():
            names[part] = f"_m{len(self.measures)}"
            self.measures.append(f"{measure} AS {names[part]}")
        observed = " + ".join(f"cast({n} AS double)" for n in names.values())
        detail = ", ".join(f"{quoted(p)}, cast({n} AS string)" for p, n in names.items())
        self.rows.append(_row(check, quoted(column), severity, observed, limit, f"map({detail})"))

    def run(self, df: DataFrame) -> DataFrame:
        counted = df.agg(*[F.expr(m) for m in self.measures])
        return counted.selectExpr(f"inline(array({', '.join(self.rows)}))")


def _row(check: str, column: str, severity: str, observed: str, limit: float, detail: str) -> str:
    """One report row as SQL; a check fails when the observed value is above its limit."""
    return (
        f"named_struct('check', '{check}', 'column', {column}, 'severity', '{severity}', "
        f"'passed', coalesce({observed} <= {limit!r}D, true), 'observed', {observed}, "
        f"'threshold', {float(limit)!r}D, 'detail', {detail})"
    )


def _add_columns(checks: _Pass, df: DataFrame, contract: Contract) -> None:
    """Contract columns that are missing; additional columns are fine."""
    missing = sorted(set(contract) - set(df.columns))
    detail = f"map('missing', {quoted(', '.join(missing))})"
    checks.rows.append(
        _row("columns", "cast(NULL AS string)", ERROR, f"{float(len(missing))}D", 0, detail)
    )


def _add_structure(checks: _Pass, df: DataFrame, contract: Contract) -> None:
    """Nulls in required columns, values out of range, null rates above their usual level."""
    for column, spec in _present(df, contract).items():
        shown = name(column)
        if not spec.nullable:
            checks.add("nullable", column, ERROR, 0, null_count=f"count_if({shown} IS NULL)")
        bounds = {}
        if spec.min_value is not None:
            bounds["below"] = f"count_if({shown} < {spec.min_value!r}D)"
        if spec.max_value is not None:
            bounds["above"] = f"count_if({shown} > {spec.max_value!r}D)"
        if bounds:
            checks.add("range", column, ERROR, 0, **bounds)
        if spec.nullable and spec.baseline_null_rate:
            rate = f"avg(cast({shown} IS NULL AS int))"
            checks.add("null_rate", column, WARNING, spec.null_rate_threshold(), null_rate=rate)


def _add_rules(checks: _Pass, df: DataFrame) -> None:
    """Rules across payments columns; a rule whose columns are missing is reported as failed."""
    code = r"regexp_extract(tipo_baixa, '^(\\d+)', 1)"
    silent = f"(tipo_baixa IS NULL OR {code} IN {in_list(fv.NON_FINANCIAL_CODES)})"
    rules = {
        ("tipo_baixa", "dt_pagamento"): {
            "mismatches": "(tipo_baixa IS NULL) <> (dt_pagamento IS NULL)",
        },
        ("vlr_baixa", "tipo_baixa"): {
            "missing_vlr_baixa": f"vlr_baixa IS NULL AND NOT {silent}",
            "unexpected_vlr_baixa": f"vlr_baixa IS NOT NULL AND {silent}",
        },
        ("dt_emissao", "dt_vencimento"): {"invalid_count": "dt_emissao > dt_vencimento"},
    }
    present = set(df.columns)
    for columns, parts in rules.items():
        missing = sum(c not in present for c in columns)
        if missing:
            counts = {"columns_missing": f"max({missing})"}
        else:
            counts = {part: f"count_if({broken})" for part, broken in parts.items()}
        checks.add("business_rule", " / ".join(columns), ERROR, 0, **counts)


def column_check(df: DataFrame, contract: Contract) -> DataFrame:
    checks = _Pass()
    _add_columns(checks, df, contract)
    return df.sparkSession.range(1).selectExpr(f"inline(array({checks.rows[0]}))")


def structural_checks(df: DataFrame, contract: Contract) -> DataFrame:
    checks = _Pass()
    _add_structure(checks, df, contract)
    return checks.run(df)


def business_rules(df: DataFrame) -> DataFrame:
    checks = _Pass()
    _add_rules(checks, df)
    return checks.run(df)


def duplicate_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows beyond the first per value, nulls being one value: ``column``, ``duplicates``."""
    parts = []
    for name in columns:
        per_value = df.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
        extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        parts.append(per_value.agg(extra.alias("duplicates")).select(F.lit(name).alias("column"), "duplicates"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def unique_checks(df: DataFrame, contract: Contract) -> DataFrame | None:
    columns = [c for c, spec in _present(df, contract).items() if spec.unique]
    if not columns:
        return None
    detail = "map('duplicate_count', cast(duplicates AS string))"
    row = _row("unique", "column", ERROR, "cast(duplicates AS double)", 0, detail)
    return duplicate_counts(df, columns).selectExpr(f"inline(array({row}))")


def _coded(df: DataFrame, contract: Contract) -> dict[str, ColumnSpec]:
    return {c: spec for c, spec in _present(df, contract).items() if spec.allowed is not None}


def unexpected_values(df: DataFrame, contract: Contract) -> DataFrame:
    """Labels outside the allowed sets with their row counts: ``column``, ``value``, ``rows``."""
    cells = ", ".join(
        f"named_struct('column', {quoted(c)}, 'value', "
        f"CASE WHEN {name(c)} NOT IN {in_list(spec.allowed)} THEN {name(c)} END)"
        for c, spec in _coded(df, contract).items()
    )
    unexpected = df.selectExpr(f"inline(array({cells}))").where("value IS NOT NULL")
    return unexpected.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def allowed_value_checks(df: DataFrame, contract: Contract) -> DataFrame | None:
    """Number of distinct unexpected labels per column; the detail names the first hundred."""
    coded = list(_coded(df, contract))
    if not coded:
        return None
    found = stored(unexpected_values(df, contract), "unexpected-values")
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    shown = found.withColumn("_rank", rank).where(F.col("_rank") <= SHOWN_VALUES)
    named = shown.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values"))
    counted = found.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1).selectExpr(f"explode(array{in_list(coded)}) AS column")
    joined = every.join(counted, "column", "left").join(named, "column", "left")
    detail = "map('unexpected_values', coalesce(array_join(values, ', '), ''))"
    observed = "cast(coalesce(n, 0) AS double)"
    row = _row("allowed_values", "column", ERROR, observed, 0, detail)
    return joined.selectExpr(f"inline(array({row}))")


def validate(df: DataFrame, contract: Contract, dataset: str, with_rules: bool | None = None) -> DataFrame:
    """The full report of one table.  Payments also get the business rules."""
    if with_rules is None:
        with_rules = contract is PAYMENTS
    checks = _Pass()
    _add_columns(checks, df, contract)
    _add_structure(checks, df, contract)
    if with_rules:
        _add_rules(checks, df)
    report = checks.run(df)
    for part in (unique_checks(df, contract), allowed_value_checks(df, contract)):
        if part is not None:
            report = report.unionByName(part)
    outcome = F.when(F.col("passed"), F.lit("within the contract")).otherwise(
        F.concat(
            F.lit("observed "), round_even("observed", 4).cast("string"),
            F.lit(", allowed up to "), round_even("threshold", 4).cast("string"),
        )
    )
    return report.withColumns({"dataset": F.lit(dataset), "message": outcome}).select(*REPORT)


def summarise(report: DataFrame) -> DataFrame:
    """Per table: whether it passed, and the failed errors and warnings.  Warnings never fail a table."""
    failed = ~F.col("passed")
    return report.groupBy("dataset").agg(
        F.bool_and(F.col("passed") | (F.col("severity") == WARNING)).alias("passed"),
        F.count_if(failed & (F.col("severity") == ERROR)).alias("errors"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    )
