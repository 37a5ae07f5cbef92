import datetime as dt

from pyspark.sql import functions as F

from lastro.contracts import AUXILIARY, PAYMENTS, struct_type
from lastro.operators import quality

DAY = dt.date(2024, 5, 1)
FULL = "0 - Baixa integral interbancaria"
BY_REQUEST = "5 - Baixa integral por solicitacao do cedente"


def payments(spark, *rows):
    """Rows of (id, paid, settled value, label); the rest is filled in."""
    filled = [
        (i, "p", "b", DAY, dt.date(2024, 5, 10), paid, 10.0, value, label, "OUTROS")
        for i, paid, value, label in rows
    ]
    schema = ", ".join(f"{n} {s.data_type.simpleString()}" for n, s in PAYMENTS.items())
    return spark.createDataFrame(filled, schema)


def observed(report):
    return {(r.check, r.column): r for r in report.collect()}


def test_value_alignment(spark):
    df = payments(
        spark, ("a", DAY, 1.0, BY_REQUEST), ("b", DAY, None, FULL), ("c", None, 2.0, None), ("d", DAY, 1.0, "x")
    )
    found = observed(quality.business_rules(df))[("business_rule", "vlr_baixa / tipo_baixa")]
    assert found.detail == {"missing_vlr_baixa": "1", "unexpected_vlr_baixa": "2"}
    assert found.observed == 3 and not found.passed


def test_null_alignment_and_dates(spark):
    df = payments(spark, ("a", None, None, FULL), ("b", DAY, 1.0, FULL)).withColumn(
        "dt_emissao", F.when(F.col("id_boleto") == "b", F.lit("2024-06-01").cast("date"))
    )
    found = observed(quality.business_rules(df))
    assert found[("business_rule", "tipo_baixa / dt_pagamento")].observed == 1
    assert found[("business_rule", "dt_emissao / dt_vencimento")].observed == 1


def test_range_is_inclusive_and_skips_nulls(spark):
    df = payments(spark, ("a", DAY, 0.0, FULL), ("b", DAY, 0.01, FULL), ("c", DAY, None, BY_REQUEST))
    assert observed(quality.structural_checks(df, PAYMENTS))[("range", "vlr_baixa")].observed == 1


def test_unexpected_labels(spark):
    df = payments(spark, ("a", DAY, 1.0, "9 - ?"), ("b", DAY, 1.0, f" {FULL}"), ("c", DAY, 1.0, FULL))
    found = observed(quality.allowed_value_checks(df, PAYMENTS))
    assert found[("allowed_values", "tipo_baixa")].observed == 2
    assert found[("allowed_values", "tipo_baixa")].detail == {"unexpected_values": f" {FULL}, 9 - ?"}
    assert found[("allowed_values", "tipo_especie")].passed


def test_repeated_values_count_nulls_as_one(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "id string")
    assert quality.duplicate_counts(df, ["id"]).first().duplicates == 3


def test_missing_columns_are_reported(spark):
    df = payments(spark, ("a", DAY, 1.0, FULL)).drop("vlr_baixa").withColumn("more", F.lit(1))
    found = observed(quality.validate(df, PAYMENTS, "payments"))
    assert found[("columns", None)].detail == {"missing": "vlr_baixa"}
    assert not found[("columns", None)].passed
    assert not found[("business_rule", "vlr_baixa / tipo_baixa")].passed


def test_warnings_do_not_fail_a_table(spark):
    rows = [(f"C{i}", None, "SP", *[0.5] * 8) for i in range(3)]
    df = spark.createDataFrame(rows, ", ".join(
        f"{n} {s.data_type.simpleString()}" for n, s in AUXILIARY.items()
    ))
    report = quality.validate(df, AUXILIARY, "auxiliary")
    r = quality.summarise(report).first()
    assert (r.passed, r.errors, r.warnings) == (True, 0, 1)
    assert observed(report)[("null_rate", "cd_cnae_prin")].message.startswith("observed 1.0, allowed up to")


def test_empty_table(spark):
    df = spark.createDataFrame([], struct_type(PAYMENTS))
    r = quality.summarise(quality.validate(df, PAYMENTS, "payments")).first()
    assert r.passed and r.errors == 0
