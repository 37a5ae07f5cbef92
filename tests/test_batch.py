import json
import pathlib

import pytest
from pyspark.sql import functions as F

from lastro.ml import models
from lastro.plans import batch
from lastro.sources import files, sinks

SMALL = models.Settings(trees=3, forest_depth=4, boosting_rounds=3, boosting_depth=3, logistic_iterations=30)


@pytest.fixture(scope="module")
def raw(book, tmp_path_factory):
    """The two tables as CSV files, with one receivable and one company delivered twice."""
    root = tmp_path_factory.mktemp("raw")
    payments = book.payments.toPandas()
    payments.loc[len(payments)] = {**payments.loc[0], "vlr_nominal": 123.45}
    payments.to_csv(root / "payments.csv", index=False)
    auxiliary = book.raw_auxiliary.toPandas()
    auxiliary.loc[len(auxiliary)] = {**auxiliary.loc[0], "uf": " sp "}
    auxiliary.to_csv(root / "auxiliary.csv", index=False)
    return root, payments, auxiliary


@pytest.fixture(scope="module")
def finished(spark, raw, tmp_path_factory):
    root, _, _ = raw
    out = tmp_path_factory.mktemp("out")
    as_of = F.lit("2002-01-01").cast("date")
    run = batch.run(
        spark, str(root / "payments.csv"), str(root / "auxiliary.csv"), str(out), as_of, SMALL
    )
    return run, pathlib.Path(out)


def test_last_delivery_wins(spark, raw, finished):
    _, payments, auxiliary = raw
    _, out = finished
    first = payments.loc[0, "id_boleto"]
    kept = spark.read.parquet(f"{out}/clean/payments").where(F.col("id_boleto") == first).collect()
    assert [r.vlr_nominal for r in kept] == [123.45]
    company = auxiliary.loc[0, "id_cnpj"]
    kept = spark.read.parquet(f"{out}/clean/auxiliary").where(F.col("id_cnpj") == company).collect()
    assert [r.uf for r in kept] == ["SP"]


def test_all_tables_are_published(spark, raw, finished):
    run, out = finished
    _, payments, _ = raw
    found, complete = files.read_published(spark, f"{out}/bi")
    assert complete and set(found) == set(files.PUBLISHED)
    scores = found["boleto_scores"]
    assert len(scores.columns) == 14 and scores.count() == len(payments) - 1
    report = {r.dataset: r for r in run.report().collect()}
    assert report["bi/boleto_scores"].rows == len(payments) - 1
    assert report["dashboard/transactions"].rows == len(payments) - 1
    empty = {name for name, r in report.items() if r.status != "ok"}
    assert empty <= {"dashboard/alerts", "quality/unexpected_payments", "quality/unexpected_auxiliary"}
    assert spark.read.parquet(f"{out}/run_report").count() == len(report)


def test_quality_report_names_the_repeated_key(spark, finished):
    _, out = finished
    report = spark.read.parquet(f"{out}/quality_report")
    row = report.where("dataset = 'payments' AND `check` = 'unique'").first()
    assert row.observed == 1 and not row.passed


def test_contract_violation_can_stop_the_run(spark, raw, tmp_path):
    root, _, _ = raw
    with pytest.raises(ValueError, match="auxiliary, payments"):
        batch.run(
            spark, str(root / "payments.csv"), str(root / "auxiliary.csv"), str(tmp_path), fail_on_error=True
        )


def test_metrics_are_written_and_ranked(spark, finished):
    _, out = finished
    text = spark.read.text(f"{out}/ml/evaluation/model_evaluation").first().value
    assert set(json.loads(text)) == set(SMALL.models)
    ranked = files.read_model_metrics(spark, f"{out}/ml/evaluation/model_evaluation").collect()
    assert {r.model for r in ranked} == {"Logistic Regression", "Random Forest", "Gradient Boosting"}
    assert [r.auc_roc for r in ranked] == sorted((r.auc_roc for r in ranked), reverse=True)
    assert ranked[0].auc_roc > 0.6
    assert files.read_model_metrics(spark, f"{out}/absent").count() == 0


def test_models_can_be_read_back(finished):
    from pyspark.ml.classification import LogisticRegressionModel

    _, out = finished
    model = LogisticRegressionModel.load(f"{out}/ml/models/{models.LOGISTIC}")
    assert model.numFeatures == 25


def test_dashboard_from_published_tables(spark, raw, finished, tmp_path):
    root, _, _ = raw
    run, out = finished
    source = batch.build_dashboard(spark, str(out), str(root / "payments.csv"), str(root / "auxiliary.csv"))
    assert source == "published tables"
    assert [r.generated_from for r in spark.read.json(f"{out}/dashboard/source").collect()] == [source]
    shown = spark.read.json(f"{out}/dashboard/transactions")
    assert shown.count() > 0 and "score_display" in shown.columns
    for name in ("summary", "filters", "beneficiaries", "payers", "feature_importance", "model_metrics"):
        assert spark.read.json(f"{out}/dashboard/{name}").count() > 0


def test_dashboard_falls_back_to_raw_files(spark, book, tmp_path):
    book.payments.toPandas().to_csv(tmp_path / "payments.csv", index=False)
    book.raw_auxiliary.toPandas().to_csv(tmp_path / "auxiliary.csv", index=False)
    source = batch.build_dashboard(
        spark, str(tmp_path / "out"), str(tmp_path / "payments.csv"), str(tmp_path / "auxiliary.csv")
    )
    assert source == "raw files"
    assert spark.read.json(f"{tmp_path}/out/dashboard/transactions").count() == book.payments.count()


def test_best_model_takes_the_first_of_equals(spark):
    metrics = spark.createDataFrame(
        [("a", 0.7), ("b", 0.9), ("c", 0.9)], "model string, auc_roc double"
    )
    assert models.best_model(metrics, ("a", "b", "c")) == "b"


def test_json_safe(spark):
    df = spark.createDataFrame(
        [(float("nan"), "x"), (float("inf"), None), (1.5, "y")], "v double, t string"
    ).withColumn("d", F.lit("2024-05-01").cast("date"))
    rows = [tuple(r) for r in sinks.json_safe(df).collect()]
    assert rows == [(None, "x", "2024-05-01"), (None, None, "2024-05-01"), (1.5, "y", "2024-05-01")]
    with pytest.raises(ValueError):
        sinks.records(df, limit=1)


def test_json_safe_reaches_nested_values(spark):
    df = spark.sql(
        "SELECT array(1.0D, double('NaN')) AS a, named_struct('d', date'2024-05-01', 'x', double('Infinity')) AS s, "
        "map('k', double('-Infinity')) AS m"
    )
    r = sinks.json_safe(df).first()
    assert (r.a, tuple(r.s), r.m) == ([1.0, None], ("2024-05-01", None), {"k": None})


def test_columns_outside_the_contract_are_kept(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id_boleto,vlr_nominal,extra\nB1,x,7\nB2,1.5,NA\n")
    df = files.load_payments(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in df.collect()] == [("B1", None, "7"), ("B2", 1.5, None)]
    assert files.read_optional(spark, str(tmp_path / "absent")) is None


def test_details_are_scored_along(spark, finished, capsys):
    """The detail holds what a join of scores and features would, without one."""
    from lastro.plans import dashboard

    _, out = finished
    stored, scores, table = (spark.read.parquet(f"{out}/{n}") for n in ("detail/transactions", "bi/boleto_scores", "features/payments_features"))
    detail, joined = dashboard.transaction_detail(stored), dashboard.transaction_detail(scores, table)
    detail.explain()
    assert "Join" not in capsys.readouterr().out
    columns = sorted(joined.columns)
    assert sorted(detail.columns) == columns
    assert detail.select(columns).exceptAll(joined.select(columns)).isEmpty() and detail.count() == joined.count()
