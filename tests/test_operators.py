import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastro.ml import metrics, prepare
from lastro.operators import joins, profile
from lastro.operators.dedup import keep_one
from lastro.operators.ranking import exact_quantiles, running_totals, unpivot

BOTH_PATHS = pytest.mark.parametrize("one_task_rows", [0, 10**9], ids=["buckets", "one window"])


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("a", 3, "y")], "id string, seq int, v string")
    kept = {r.id: r.seq for r in keep_one(df, ["id"], F.col("seq")).collect()}
    assert kept == {"b": 2, "a": 3}
    first = {r.id: r.seq for r in keep_one(df, ["id"], F.col("seq"), keep="first").collect()}
    assert first == {"b": 2, "a": 1}
    alone = [r.id for r in keep_one(df, ["id"], F.col("seq"), keep=False).collect()]
    assert alone == ["b"]


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "id string, seq int")
    assert [tuple(r) for r in keep_one(df, ["id"], F.col("seq")).collect()] == [(None, 2)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a few have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
    )
    fact = spark.range(3000).select(F.col("id").alias("row"), key.alias("key"))
    dim = spark.range(60).select(
        F.when(F.col("id") == 59, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        (F.col("id") * 10).alias("v"),
    )
    return fact, dim


def test_split_keys_give_the_plain_join(spark, skewed, monkeypatch):
    fact, dim = skewed
    expected = sorted(map(str, fact.join(dim, "key", "left").select("row", "key", "v").collect()))
    monkeypatch.setattr(joins, "is_small", lambda *_: False)
    joined = joins.left_join_many_to_one(fact, dim, "key", "row", min_hot_rows=100)
    assert sorted(map(str, joined.select("row", "key", "v").collect())) == expected


def test_hot_key_is_cut_into_pieces(skewed):
    fact, _ = skewed
    counts = fact.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"))
    hot = joins.hot_keys(counts, "key", min_hot_rows=100).collect()
    assert [(r["key"], r["_pieces"]) for r in hot] == [("hot", 10)]


def test_repeated_dimension_key_is_refused(spark):
    df = spark.createDataFrame([("a",), ("a",)], "id string")
    with pytest.raises(ValueError):
        joins.require_unique(df, "id")


@BOTH_PATHS
def test_quantiles(spark, one_task_rows):
    rng = random.Random(7)
    rows = [
        (rng.choice([None, float(rng.randint(0, 20)), rng.random() * 5]), rng.gauss(0, 9)) for _ in range(1500)
    ]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    probabilities = (0, 0.1, 0.25, 0.5, 0.9, 1)
    found = exact_quantiles(
        df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}, probabilities, one_task_rows=one_task_rows
    )
    by_series = {r.series: [r[f"q{i}"] for i in range(len(probabilities))] for r in found.collect()}
    assert set(by_series) == {"a", "b"}
    for i, name in enumerate("ab"):
        expected = np.quantile([r[i] for r in rows if r[i] is not None], probabilities)
        np.testing.assert_allclose(by_series[name], expected, rtol=1e-12)


@BOTH_PATHS
def test_weighted_median_equals_repeated_rows(spark, one_task_rows):
    pairs = [(1.0, 3), (2.0, 1), (8.0, 2), (9.0, 5)]
    df = spark.createDataFrame(pairs, "x double, n int")
    found = exact_quantiles(df, {"x": F.col("x")}, [0.5], F.col("n"), one_task_rows)
    assert found.first().q0 == np.median(np.repeat([p[0] for p in pairs], [p[1] for p in pairs]))


def test_median_of_two_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert prepare.fit_medians(df, ["x"]).first().q0 == 1.5


@BOTH_PATHS
def test_running_totals(spark, one_task_rows):
    rng = random.Random(3)
    xs = [float(rng.randint(0, 700)) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = running_totals(unpivot(df, {"s": F.col("x")}), descending=True, one_task_rows=one_task_rows).collect()
    assert len(rows) == len(set(xs))
    for r in rows:
        assert r.cum_w == sum(x >= r.x for x in xs) and r.all_w == len(xs)


def pairwise_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def step_precision(pairs):
    total, value, earlier = sum(y for _, y in pairs), 0.0, 0.0
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        called = [y for s, y in pairs if s >= cut]
        recall = sum(called) / total
        value += (recall - earlier) * sum(called) / len(called)
        earlier = recall
    return value


@BOTH_PATHS
def test_ranking_metrics_against_brute_force(spark, one_task_rows):
    rng = random.Random(11)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "s double, y int").repartition(4)
    found = metrics.ranking_metrics(
        df, {"m": F.col("s"), "flat": F.lit(0.5)}, F.col("y"), one_task_rows
    ).collect()
    by_series = {r.series: r for r in found}
    assert by_series["m"].auc_roc == pytest.approx(pairwise_auc(pairs), abs=1e-12)
    assert by_series["m"].auc_pr == pytest.approx(step_precision(pairs), abs=1e-12)
    assert by_series["flat"].auc_roc == 0.5


def test_published_confusion_gives_published_f1(spark):
    cells = {(0, 0): 890, (0, 1): 102, (1, 0): 125, (1, 1): 307}
    rows = [k for k, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "y int, p int")
    r = metrics.confusion(df, {"m": F.col("p")}, F.col("y")).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (890, 102, 125, 307)
    assert round(r.f1, 4) == 0.7301


def test_describe_and_histogram(spark):
    xs = [float(i % 17) for i in range(500)] + [40.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    r = profile.describe(df, {"x": F.col("x")}).first()
    assert r["count"] == 501 and r["max"] == 40.0
    assert r["std"] == pytest.approx(np.std(xs, ddof=1), abs=1e-4)
    counts = [row["count"] for row in profile.histogram(df, F.col("x")).collect()]
    assert counts == list(np.histogram(xs, bins=50)[0])


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert sum(r["count"] for r in profile.histogram(df, F.col("x")).collect()) == 2


def test_value_counts_keep_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, F.col("v"), "v").collect()] == [("a", 2), (None, 1)]


def test_stored_tables_can_be_discarded(spark):
    import pathlib

    from lastro.session import discard, stored

    first = stored(spark.range(10), "test")
    second = stored(first.groupBy((F.col("id") % 3).alias("k")).count(), "test")
    folder = pathlib.Path(first.stored_at.removeprefix("file:"))
    assert folder.exists() and second.count() == 3
    discard(first)
    assert not folder.exists() and second.count() == 3
