import datetime as dt

from pyspark.sql import functions as F

import pytest

from lastro.functions import dates, measures, risk, text
from lastro.plans import scoring
from lastro.plans.features import add_label, add_temporal_features
from lastro.plans.portfolio import probability_bucket
from lastro.sources import files


def values(spark, rows, column, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def payments(spark, *paid, due=dt.date(2024, 5, 10)):
    rows = [(f"B{i}", dt.date(2024, 5, 1), due, p) for i, p in enumerate(paid)]
    return spark.createDataFrame(
        rows, "id_boleto string, dt_emissao date, dt_vencimento date, dt_pagamento date"
    )


def test_default_rule(spark):
    df = payments(spark, dt.date(2024, 5, 9), dt.date(2024, 5, 11), None)
    flags = [r.is_defaulted for r in add_label(df).orderBy("id_boleto").collect()]
    assert flags == [0, 1, 1]
    loose = [r.is_defaulted for r in add_label(df, threshold=5).orderBy("id_boleto").collect()]
    assert loose == [0, 0, 1]


def test_paid_without_delay_is_not_defaulted(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None)], "paid date, delay int")
    assert df.select(dates.default_flag(F.col("paid"), F.col("delay"))).first()[0] == 0


def test_temporal_features(spark):
    df = payments(spark, dt.date(2024, 5, 9), None)
    first, second = add_temporal_features(df, F.lit("2024-05-20").cast("date")).orderBy("id_boleto").collect()
    assert (first.boleto_term_days, first.payment_delay_days, first.days_overdue) == (9, -1, 0)
    assert (second.payment_delay_days, second.days_overdue) == (None, 10)
    assert (first.due_month, first.due_day_of_week) == (5, 4)  # a Friday


def test_overdue_can_be_negative(spark):
    df = add_temporal_features(payments(spark, None), F.lit("2024-05-01").cast("date"))
    assert df.first().days_overdue == -9


def test_risk_bands(spark):
    bands = values(spark, [29.9, 30.0, 59.9, 60.0, None], lambda c: risk.risk_band(c, 100))
    assert bands == ["low", "medium", "medium", "high", "high"]
    assert values(spark, [0.2999, 0.3, 0.6], risk.risk_band) == ["low", "medium", "high"]


def test_band_follows_rounded_probability(spark):
    df = spark.createDataFrame([(0.29996,)], "p double").select(*risk.score_outputs(F.col("p")))
    assert tuple(df.first()) == (0.3, 30.0, "medium")


def test_settlement_code(spark):
    codes = values(
        spark, [" 5 - x ", "x", None, "\t12 y"], lambda c: text.settlement_code(text.strip(c)), "string"
    )
    assert codes == [5, None, None, 12]


def test_cnae_division(spark):
    found = values(spark, ["62015.0", "6201501", None, "abc", "62.015-01"], text.cnae_division, "string")
    assert found == ["00", "62", None, None, "00"]
    assert values(spark, [62015.0, 6201501.0, 9999999.0], text.cnae_division_of_number) == ["00", "62", "99"]


def test_cnae_label(spark):
    shown = values(spark, ["62", "04"], text.cnae_label, "string")
    assert shown == ["Tecnologia da informacao (CNAE 62)", "Setor CNAE (CNAE 04)"]


def test_buckets(spark):
    edges = [i * 0.1 for i in range(11)]
    found = values(
        spark, [0.0, 0.1, 0.1001, 0.3, 1.0, -0.1, 1.1, None], lambda c: probability_bucket(c, edges)
    )
    assert found == [0, 0, 1, 2, 9, None, None, None]


def test_min_max(spark):
    def scaled(rows):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v double")
        return [r[0] for r in df.select(scoring.normalise(df, "v"), "i").orderBy("i").collect()]

    assert scaled([0.0, 5.0, None, 10.0]) == [0.0, 0.5, 0.0, 1.0]
    assert scaled([3.0, 3.0]) == [0.0, 0.0]
    assert scaled([None, None]) == [0.0, 0.0]


def test_clip_keeps_null(spark):
    assert values(spark, [-1.0, 0.5, 7.0, None], lambda c: risk.clip(c, 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_round_even(spark):
    assert values(spark, [0.5, 1.5, 2.5], lambda c: measures.round_even(c, 0)) == [0.0, 2.0, 2.0]
    assert values(spark, [0.575], lambda c: measures.round_even(c, 2)) == [0.57]


def test_unreadable_input_becomes_null(spark):
    df = spark.createDataFrame(
        [("2024-05-01", "1.5"), ("2024-05-01 10:00:00", "x"), ("nope", ""), (None, None)], "d string, n string"
    )
    rows = files.coerce_types(df, ["d", "absent"], ["n"]).collect()
    day = dt.date(2024, 5, 1)
    assert [tuple(r) for r in rows] == [(day, 1.5), (day, None), (None, None), (None, None)]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA",), ("nan",), ("",), ("x",), ("na",)], "v string")
    assert [r.v for r in files.null_tokens(df).collect()] == [None, None, None, "x", "na"]


def test_feature_label(spark):
    shown = values(spark, ["vlr_nominal", "payer_cd_cnae_prin", "due_month"], text.feature_label, "string")
    assert shown == ["Valor nominal do boleto", "Pagador - Cd Cnae Prin", "Due Month"]


def test_short_ids(spark):
    assert values(spark, ["abcdefghijklmnop", None], text.compact_id, "string") == ["abcdefghijkl", None]


def test_numbers_and_month_first_dates(spark):
    df = spark.createDataFrame(
        [("10D", "03/04/2024"), (" 1.5e3 ", "2024-03-04"), ("0x1F", "13/13/2024"), ("-.5", None), ("1,000", "x")],
        "n string, d string",
    )
    rows = files.coerce_types(df, ["d"], ["n"]).collect()
    assert [r.n for r in rows] == [None, 1500.0, None, -0.5, None]
    assert [r.d and r.d.isoformat() for r in rows] == ["2024-03-04", "2024-03-04", None, None, None]


def test_csv_as_other_tools_write_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"say ""hi"", ok"\n2,"two\nlines"\n3,plain\n')
    rows = files.read_csv(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", 'say "hi", ok'), ("2", "two\nlines"), ("3", "plain")]
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,x\n")
    (folder / "b.csv").write_text("v,id\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(folder)).collect()
