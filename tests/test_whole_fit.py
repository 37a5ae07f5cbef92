"""Models are fitted on all train rows, in as many parts as their number needs, with the same result."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lastro import contracts
from lastro.catalog import queries
from lastro.ml import blocks, models, trees

PLANS = {"f": trees.Plan(4, None, False), "b": trees.Plan(5, 4, True)}


def some(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.normal(size=n), rng.integers(0, 400, n), rng.normal(size=n).round(1)], axis=1)
    return x.astype(float), ((x[:, 0] > 2) ^ (x[:, 1] > 0.4) ^ (rng.random(n) < 0.2)).astype(float)


def fitted(spark, x, y, weight=3.7):
    weights = np.where(y == 1, weight, 0.61)
    rows = trees.fit(spark, x, y, {"f": weights, "b": weights}, PLANS).toArrow()
    return {m: trees.Ensemble.of(rows.filter(np.array(rows["model"]) == m), x.shape[1], PLANS[m].boosted) for m in PLANS}


def shape(model):
    """The trees as read from their roots, whatever the numbers of their nodes."""
    found = []
    for root in model.roots:
        stack = [root]
        while stack:
            node = stack.pop()
            if model.left[node] == node:
                found.append(("leaf", float(model.value[node])))
            else:
                found.append((int(model.feature[node]), float(model.threshold[node])))
                stack += [model.left[node] + 1, model.left[node]]
    return found


def test_models_are_fitted_on_all_train_rows(spark, book, monkeypatch):
    seen = {}
    monkeypatch.setattr(models.bounded, "__defaults__", (models.Settings(labelled_rows=100),))
    monkeypatch.setattr(models, "train_models", lambda rows: seen.setdefault("rows", rows) and {})
    monkeypatch.setattr(models, "evaluate_models", lambda *a: spark.range(1))
    table = queries.fit_models(book)[0]
    train = queries.prepare.stratified_split(queries.prepare.select_features(table)).where("split = 'train'")
    assert seen["rows"].count() == train.count() > 1000


def test_trees_weigh_every_row_of_a_large_table(spark):
    x, y = np.arange(45_000.0).reshape(-1, 1) % 90, np.zeros(45_000)
    y[x[:, 0] == 7] = 1
    rows = spark.range(45_000).select(
        F.array((F.col("id") % 90).cast("double")).alias("features"), (F.col("id") % 90 == 7).cast("int").alias("y"), F.lit(1.0).alias("w")
    )
    given = trees.inputs(rows, "y", {"b": "w"})
    assert given.blocks.rows == 45_000 and sum(given.blocks.held.values()) == 90
    grown = trees.fit(spark, given, plans={"b": trees.Plan(1, 2, True)}).toArrow()
    model = trees.Ensemble.of(grown, 1, True)
    # Value of a leaf: gradients over curvatures of all its rows, and the penalty of one.
    assert model.predict(np.array([[7.0]]))[0] == pytest.approx(1 / (1 + np.exp(-0.1 * 250 / 126)), abs=1e-9)


def test_trees_are_the_same_in_parts(spark, monkeypatch):
    x, y = some()
    whole = fitted(spark, x, y)
    monkeypatch.setattr(trees, "HELD", 300)
    held = fitted(spark, x, y)
    for model in PLANS:
        assert shape(whole[model]) == shape(held[model])
    assert max(np.diff(np.append(whole["f"].roots, len(whole["f"].left)))) > 500
    monkeypatch.setattr(blocks, "ROWS", 500)
    monkeypatch.setattr(trees, "ALONE", 0)
    over, plain = [], trees._boosted_over_parts
    monkeypatch.setattr(trees, "_boosted_over_parts", lambda *a: over.append(len(a[1].parts)) or plain(*a))
    blocked = fitted(spark, x, y)
    assert over == [3] and shape(blocked["b"]) == shape(whole["b"])     # draws are by block, and boosting has none
    monkeypatch.setattr(trees, "HELD", 1 << 20)
    assert shape(fitted(spark, x, y)["f"]) == shape(blocked["f"])


def test_trees_do_not_depend_on_partitions_or_order(spark):
    x, y = some(800)
    rows = spark.createDataFrame([(row.tolist(), float(v), 1.3 if v else 0.4) for row, v in zip(x, y)], "features array<double>, y double, w double")
    found = []
    for table in (rows.coalesce(1), rows.orderBy(F.rand(1)).repartition(7)):
        grown = trees.fit(spark, trees.inputs(table, "y", {"f": "w", "b": "w"}), plans=PLANS).toArrow()
        found.append([shape(trees.Ensemble.of(grown.filter(np.array(grown["model"]) == m), 4, PLANS[m].boosted)) for m in PLANS])
    assert found[0] == found[1]


def test_cuts_come_from_all_rows(spark):
    x, y = some(5000)
    x[:7, 1], x[7:9, 3] = [0.0, -0.0, np.inf, -np.inf, 5.0, 5.0, 5.0], 0.0
    rows = spark.createDataFrame([(row.tolist(),) for row in x], "features array<double>").repartition(5)
    for bins in (256, 16):
        for a, b in zip(blocks.cut_table(rows, 4, bins), trees.cut_points(x, bins), strict=True):
            assert np.array_equal(a, b)


def test_equal_rows_are_one_with_copies(spark):
    x, y = np.repeat([[1.0, 2.0], [3.0, 2.0], [4.0, 9.0]], [4000, 5, 300], axis=0), np.repeat([0.0, 1.0, 1.0], [4000, 5, 300])
    given = trees.inputs(spark.createDataFrame([(r.tolist(), float(v), 1.0) for r, v in zip(x, y)], "features array<double>, y double, w double"), "y", {"f": "w"})
    (block,) = given.blocks.read(0)
    assert sorted(block.copies) == [5, 300, 4000] and given.blocks.rows == 4305
    drawn = trees.Bootstrap.of(given.blocks, PLANS["f"], 0)
    assert sum(int(times.sum()) for _, _, times in drawn.stream()) == 4305
    model = fitted(spark, x, y)["f"]
    assert np.array_equal(model.predict(x) > 0.5, y == 1)


def test_forest_in_files_predicts_as_in_memory(spark, tmp_path, monkeypatch):
    x, y = some(1500)
    monkeypatch.setattr(trees, "HELD", 200)
    matrix = spark.createDataFrame([(Vectors.dense(v), int(t)) for v, t in zip(x, y)], ["features", contracts.TARGET])
    settings = models.Settings(models=(models.FOREST, models.BOOSTED), trees=7, boosting_rounds=3, boosting_depth=3)
    trained = models.train_models(matrix, settings, str(tmp_path))
    forest = trained[models.FOREST]
    rows = spark.read.parquet(f"{tmp_path}/trees").where(F.col("model") == models.FOREST).toArrow()
    held = trees.Ensemble.of(rows, 4, False)
    x[0, 1], x[1, 2] = np.nan, np.inf
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, x array<double>").repartition(3)
    for most in (1 << 20, 100):
        own = trees.Forest(forest.path, forest.model, forest.trees, forest.cuts, forest.gains, most)
        found = frame.select("i", own.probability(F.col("x")).alias("p"), trained[models.BOOSTED].probability(F.col("x")).alias("q"))
        assert np.allclose([r.p for r in found.orderBy("i").collect()], held.predict(x), atol=1e-12)
    assert frame.where("i < 0").select(forest.probability(F.col("x"))).collect() == []
    assert np.allclose(forest.importances(), held.importances()) and forest.trees == 7
