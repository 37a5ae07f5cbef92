import datetime as dt

import pytest
from pyspark.sql import functions as F

from lastro import contracts
from lastro.catalog.views import AS_OF
from lastro.ml import metrics, prepare
from lastro.operators import joins
from lastro.plans import alerts, cleaning, dashboard, enrichment, features, portfolio, scoring

DAY = dt.date(2024, 5, 1)


def canonical(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


def test_feature_table_equals_the_steps_one_by_one(book, monkeypatch):
    as_of = F.lit(AS_OF).cast("date")
    payments = cleaning.clean_payments(book.payments)
    built = features.build_features(payments, book.auxiliary, as_of)
    assert len(built.columns) == 47
    step = features.add_temporal_features(enrichment.enrich(payments, book.auxiliary), as_of)
    for role in contracts.ROLES:
        step = features.add_behaviour(step, role)
    assert built.columns == step.columns or set(built.columns) == set(step.columns)
    expected = canonical(step)
    assert canonical(built) == expected

    monkeypatch.setattr(joins, "is_small", lambda *_: False)
    salted = features.build_features(payments, book.auxiliary, as_of, min_hot_rows=20)
    assert canonical(salted) == expected


def test_enrich_keeps_every_receivable(book):
    df = enrichment.enrich(book.payments, book.auxiliary)
    assert df.count() == book.payments.count()
    assert len(df.columns) == 30


def test_only_companies_that_occur_are_joined(book, monkeypatch):
    expected = canonical(enrichment.enrich(book.payments, book.auxiliary))
    joined = []
    plain = enrichment.left_join_many_to_one
    monkeypatch.setattr(enrichment, "left_join_many_to_one", lambda fact, dim, *a, **k: joined.append(dim) or plain(fact, dim, *a, **k))
    assert canonical(enrichment.enrich(book.payments, book.auxiliary, small_bytes=0)) == expected
    for dim, role in zip(joined, contracts.ROLES):
        known = book.payments.select(role.key).distinct().join(dim.select(role.key), role.key)
        assert dim.count() == known.count() < book.auxiliary.count()


def test_null_company_key_matches_nothing(spark, book):
    df = book.payments.limit(20).withColumn("id_pagador", F.lit(None).cast("string"))
    assert enrichment.enrich_role(df, book.auxiliary, contracts.PAYER).where("payer_uf IS NOT NULL").count() == 0
    rate = {r.role: r for r in enrichment.match_rates(df, book.auxiliary).collect()}
    assert rate["payer"].match_rate == 0 and rate["payer"].below_expected
    assert rate["beneficiary"].match_rate == 1 and not rate["beneficiary"].below_expected


def test_fractional_sector_code_is_refused(spark):
    df = spark.createDataFrame([(" sp ", 62015.5)], "uf string, cd_cnae_prin double")
    with pytest.raises(Exception, match="fractional sector code"):
        cleaning.clean_auxiliary(df).collect()
    df = spark.createDataFrame([(" sp ", 62015.0), (None, None)], "uf string, cd_cnae_prin double")
    assert [tuple(r) for r in cleaning.clean_auxiliary(df).collect()] == [("SP", 62015), (None, None)]


@pytest.fixture(scope="module")
def scored(book):
    from lastro.session import stored

    return stored(book.scored, "scored")


def test_bands_add_up(scored):
    r = portfolio.portfolio_overview(scored).first()
    assert r.high_risk_count + r.medium_risk_count + r.low_risk_count == r.total_boletos == scored.count()
    assert r.defaulted_portfolio_value + r.non_defaulted_value == pytest.approx(r.total_portfolio_value)
    assert r.defaulted_boletos + r.non_defaulted_boletos == r.total_boletos


def test_groups_add_up(scored):
    for role in contracts.ROLES:
        grouped = portfolio.entity_risk(scored, role).agg(F.sum("total_boletos")).first()[0]
        assert grouped == scored.count()
        known = scored.where(F.col(f"{role.prefix}_uf").isNotNull()).count()
        part = portfolio.uf_analysis(scored).where(F.col("perspective") == role.prefix)
        assert part.agg(F.sum("total_boletos")).first()[0] == known


def test_null_groups_only_in_the_raw_tables(scored):
    regular = portfolio.uf_analysis(scored).where("uf IS NULL").count()
    raw = portfolio.tables_from_raw(scored)["uf_analysis"].where("uf IS NULL").count()
    assert (regular, raw) == (0, 2)


def test_results_do_not_depend_on_partitions(scored):
    for build in (
        portfolio.portfolio_overview, portfolio.temporal_analysis, portfolio.uf_analysis,
        lambda d: portfolio.entity_risk(d, contracts.PAYER, rounded=False),
        lambda d: metrics.ranking_metrics(d, {"m": F.col("default_probability")}, F.col("is_defaulted")).select(
            "series", F.round("auc_roc", 12), F.round("auc_pr", 12)
        ),
    ):
        assert canonical(build(scored.repartition(1))) == canonical(build(scored.repartition(8)))


def test_empty_portfolio(scored):
    empty = scored.where("false")
    r = portfolio.portfolio_overview(empty).first()
    assert r.total_boletos == 0 and r.total_portfolio_value == 0.0 and r.default_rate is None
    assert portfolio.score_distribution(empty).count() == 0
    assert alerts.make_alerts(portfolio.entity_risk(empty, contracts.BENEFICIARY)).count() == 0
    k = dashboard.kpis(dashboard.with_display_columns(empty)).first()
    assert tuple(k) == (0, 0.0, 0, 0.0, 0.0, 0)


def test_orders_of_published_tables(scored):
    rates = [(r.perspective, -r.default_rate) for r in portfolio.uf_analysis(scored).collect()]
    assert rates == sorted(rates)
    sizes = [(r.perspective, -r.total_boletos) for r in portfolio.cnae_analysis(scored).collect()]
    assert sizes == sorted(sizes)
    scores = [r.avg_risk_score for r in portfolio.entity_risk(scored, contracts.PAYER).collect()]
    assert scores == sorted(scores, reverse=True)


def entities(spark, *rows):
    return spark.createDataFrame(
        [(f"S{i}", s, r, 1000.0, "SP", 4600001, "high", 3) for i, (s, r) in enumerate(rows)],
        "id_beneficiario string, avg_risk_score double, default_rate double, total_value double, "
        "uf string, cd_cnae_prin bigint, risk_category string, total_boletos bigint",
    )


def test_alert_cascade(spark):
    found = alerts.make_alerts(entities(spark, (80.0, 0.0), (50.0, 0.6), (65.0, 0.1), (10.0, 0.1))).collect()
    assert [(r.level, r.alert_type, r.status) for r in found] == [
        ("Alerta", "Inadimplencia", "Em analise"), ("Atencao", "Concentracao", "Aberto"),
        ("Critico", "Score", "Aberto"),
    ]
    assert [r.description for r in found] == [
        "Inadimplencia observada de 60.0% na entidade.",
        "Entidade em alto risco com score 650/1000.",
        "Score preditivo em 800/1000 com exposicao de R$ 1,000.",
    ]


def test_alert_candidates_are_the_riskiest(spark):
    df = entities(spark, *[(float(i), 0.9) for i in range(100)])
    assert alerts.make_alerts(df).count() == 100
    found = alerts.make_alerts(df, candidates=80)
    assert found.count() == 80 and found.agg(F.min("risk_score")).first()[0] == 20.0


def test_priority_queue_order(spark):
    df = entities(spark, (50.0, 0.0), (60.0, 0.0), (60.0, 0.0), (99.0, 0.0)).withColumn(
        "risk_category", F.when(F.col("id_beneficiario") == "S3", "medium").otherwise("high")
    )
    queue = alerts.priority_queue(df, "id_beneficiario", 3).collect()
    assert [r.id_beneficiario for r in queue] == ["S1", "S2", "S0"]


def test_aging(spark):
    rows = [
        ("S", -1, 0, DAY), ("S", 0, 0, DAY), ("S", 3, 1, DAY), ("S", 20, 1, DAY), ("S", 90, 1, DAY), ("S", None, 1, None),
    ]
    df = spark.createDataFrame(
        rows, "id_beneficiario string, payment_delay_days int, is_defaulted int, dt_pagamento date"
    )
    found = {r["bucket"]: r["count"] for r in dashboard.aging_buckets(df).collect()}
    assert found == {"Em dia": 2, "1-15d": 1, "16-60d": 1, ">60d": 1, "Aberto": 1}
    assert sum(found.values()) == len(rows)


def test_mean_with_gaps(spark):
    df = spark.createDataFrame([(4.0,), (None,)], "x double")
    assert df.agg(dashboard.mean_with_gaps(F.col("x"))).first()[0] == 2.0
    assert df.where("false").agg(dashboard.mean_with_gaps(F.col("x"))).first()[0] == 0.0


def test_filters_combine(scored):
    detail = dashboard.with_display_columns(scored)
    everything = dashboard.filter_transactions(detail, dashboard.Filters())
    assert everything.count() == detail.count()
    month = detail.groupBy("period_month").count().orderBy(F.desc("count")).first()
    picked = dashboard.filter_transactions(detail, dashboard.Filters(period=month.period_month))
    assert picked.count() == month["count"]
    high = dashboard.filter_transactions(detail, dashboard.Filters(risk="high", search="ALTO"))
    assert high.count() == detail.where("risk_category = 'high'").count()
    known = dashboard.Filters(search="medio")
    assert dashboard.filter_transactions(detail, known, include_search=False).count() == detail.count()


def test_period_filter_reaches_the_scan(scored):
    detail = dashboard.with_display_columns(scored)
    picked = dashboard.filter_transactions(detail, dashboard.Filters(period="1998-03"))
    plan = picked.select("id_boleto")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(dt_emissao,1998-03-01)" in plan
    assert "LessThan(dt_emissao,1998-04-01)" in plan
    assert "vlr_nominal" not in plan


def test_rules_fit_on_nothing(book):
    fitted = scoring.RuleScore.fit(book.payments.where("false"), book.auxiliary)
    assert fitted.liquidity is None and fitted.delay == (None, None)


def test_split_is_stable_and_stratified(book):
    df = features.add_label(book.payments)
    one = prepare.stratified_split(df.repartition(1)).select("id_boleto", "split")
    many = prepare.stratified_split(df.repartition(7)).select("id_boleto", "split")
    assert canonical(one) == canonical(many)
    shares = prepare.stratified_split(df).groupBy("is_defaulted").agg(F.avg((F.col("split") == "test").cast("int")))
    for _, share in shares.collect():
        assert share == pytest.approx(0.2, abs=0.005)


def encoded_frame(spark, rows):
    return spark.createDataFrame(rows, "id_boleto string, tipo_especie string, vlr_nominal double")


def test_preprocessor_is_fitted_on_train_only(spark):
    train = encoded_frame(spark, [("1", "b", 1.0), ("2", "a", 2.0), ("3", None, None)])
    fitted = prepare.Preprocessor.fit(train)
    codes = {r["value"]: r["code"] for r in fitted.categories.collect()}
    assert codes == {"UNKNOWN": 0.0, "a": 1.0, "b": 2.0}
    test = encoded_frame(spark, [("4", "z", None), ("5", "a", 7.0), ("6", None, 9.0)])
    found = {r.id_boleto: (r.tipo_especie, r.vlr_nominal) for r in fitted.transform(test).collect()}
    assert found == {"4": (-1.0, 1.5), "5": (1.0, 7.0), "6": (0.0, 9.0)}


def test_codes_follow_text_order(spark):
    values = ["1000", "200", "30", "1001", "2", "Ç", "abc", "ab", ""]
    df = spark.createDataFrame([(v,) for v in values * 2], "c string")
    found = {r["value"]: r["code"] for r in prepare.fit_categories(df, ["c"]).collect()}
    assert found == {v: float(i) for i, v in enumerate(sorted(values))}


def test_column_without_values_is_refused(spark):
    with pytest.raises(ValueError, match="vlr_nominal"):
        prepare.Preprocessor.fit(encoded_frame(spark, [("1", "a", None)]))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "is_defaulted int")
    found = {r.label: (r.balanced_weight, r.negative_to_positive) for r in prepare.class_weights(df).collect()}
    assert found == {0: (pytest.approx(2 / 3), 3.0), 1: (2.0, 3.0)}


def test_feature_audit(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (1.0, 4.0, None)], "vlr_nominal double, due_month double, payer_uf string")
    found = {r.feature: (r.zero_variance, r.nulls) for r in prepare.feature_audit(df).collect()}
    assert found == {"vlr_nominal": (True, 0), "due_month": (False, 0), "payer_uf": (True, 2)}


def test_leakage_audit(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "payer_boleto_count int, days_overdue int")
    found = {r["column"]: (r.present, r["values"]) for r in prepare.leakage_audit(df).collect()}
    assert found["payer_boleto_count"] == (True, 2) and found["days_overdue"] == (True, 1)
    assert found["vlr_baixa"] == (False, 0)
    assert prepare.leaky_columns(df) == ["days_overdue", "payer_boleto_count"]
