import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lastro import contracts
from lastro.ml import models, prepare, trees

SMALL = models.Settings(trees=5, boosting_rounds=5, boosting_depth=3, logistic_iterations=30)


def some(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, n), rng.normal(size=n), rng.normal(size=n), np.zeros(n)], axis=1).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 0.3)).astype(float)
    return x, y


def best_split(x, g, h, penalty, least):
    """Largest gain over all features and all cuts between values."""
    found = 0.0
    for column in x.T:
        for cut in np.unique(column)[:-1]:
            left = column <= cut
            sums = [(g[m].sum(), h[m].sum()) for m in (left, ~left)]
            if min(b for _, b in sums) >= least:
                found = max(found, sum(a * a / (b + penalty) for a, b in sums) - g.sum() ** 2 / (h.sum() + penalty))
    return found


def test_first_split_is_the_best_of_all():
    x, y = some()
    h = np.random.default_rng(2).uniform(0.5, 2, len(y))
    cuts = trees.cut_points(x[:150], 256)
    bins = trees.binned(x[:150], cuts)
    tree, _ = trees.grow(bins, cuts, (y * h)[:150], h[:150], 1, 1.0, 1.0, 4, np.random.default_rng(0))
    assert tree.gain[0] == pytest.approx(best_split(x[:150], (y * h)[:150], h[:150], 1.0, 1.0))


def rows_of(spark, x, y, weights, plans):
    return {m: trees.Ensemble.of(t, x.shape[1], plans[m].boosted) for m, t in (
        (m, trees.fit(spark, x, y, weights, plans).where(F.col("model") == m).toArrow()) for m in plans
    )}


def test_forest_without_limit_is_pure_and_boosting_follows_its_gradient(spark):
    x, y = some()
    plans = {"f": trees.Plan(30, None, False), "b": trees.Plan(40, 4, True)}
    ones = np.ones(len(y))
    fitted = rows_of(spark, x, y, {"f": ones, "b": ones}, plans)
    assert len(fitted["f"].roots) == 30 and len(fitted["b"].roots) == 40
    leaves = fitted["f"].left == np.arange(len(fitted["f"].left))
    assert set(np.round(fitted["f"].value[leaves], 9)) <= {0.0, 1.0}
    for model in fitted.values():
        assert ((model.predict(x) > 0.5) == y).mean() > 0.98
        assert model.importances().sum() == pytest.approx(1) and model.importances()[3] == 0
    cuts = trees.cut_points(x, 256)
    grown = list(trees.boosted_trees(trees.binned(x, cuts), cuts, y, ones, plans["b"]))
    margin, losses = np.zeros(len(y)), []
    for tree in grown:
        node = np.zeros(len(y), int)
        for _ in range(5):
            node = tree.left[node] + (x[np.arange(len(y)), tree.feature[node]] > tree.threshold[node])
        margin += tree.value[node]
        losses.append(np.log1p(np.exp(np.where(y == 1, -margin, margin))).mean())
    assert losses == sorted(losses, reverse=True)
    assert np.allclose(1 / (1 + np.exp(-margin)), fitted["b"].predict(x))


def test_fit_without_rows_or_with_one_label(spark):
    x = np.zeros((3, 2))
    plans = {"f": trees.Plan(2, None, False), "b": trees.Plan(2, 3, True)}
    for y in (np.zeros(3), np.ones(3)):
        for model in rows_of(spark, x, y, {"f": np.ones(3), "b": np.ones(3)}, plans).values():
            assert (np.round(model.predict(x)) == y).all()


def node_by_node(model, x):
    """Predictions that follow each row of inputs through each tree, as the trees are written."""
    found = []
    for row in x:
        leaves = []
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] + int(row[model.feature[node]] > model.threshold[node])
            leaves.append(model.value[node])
        found.append(1 / (1 + np.exp(-np.array(leaves).sum())) if model.boosted else np.array(leaves).mean())
    return np.array(found)


def test_predictions_are_those_of_every_tree_and_drop_rows_at_their_leaf(spark, monkeypatch):
    x, y = some()
    plans = {"f": trees.Plan(30, None, False), "b": trees.Plan(20, 4, True)}
    fitted = rows_of(spark, x, y, {"f": np.ones(len(y)), "b": np.ones(len(y))}, plans)
    odd = np.concatenate([x[:60], fitted["f"].threshold[:40, None].repeat(4, axis=1)])
    odd[3], odd[4, 1], odd[5, 1], odd[6, 2] = np.nan, np.inf, -np.inf, -0.0
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(odd)], "i int, x array<double>")
    for model in fitted.values():
        expected = node_by_node(model, odd)
        assert np.array_equal(model.predict(odd), expected)
        found = frame.repartition(3).select("i", model.probability(F.col("x")).alias("p")).orderBy("i").collect()
        assert [r.p for r in found] == list(expected)
        assert len(model.predict(odd[:0])) == 0
    depths = []
    for nodes in fitted["f"].walk.nodes:
        level, deep = [0], 0
        while level := [c for n in level if nodes[n] & 0xFFFF != 0xFFFF for c in (nodes[n] >> 32, (nodes[n] >> 32) + 1)]:
            deep += 1
        depths.append(deep)
    assert max(depths) > 6
    seen = []
    monkeypatch.setattr(np, "flatnonzero", lambda a, plain=np.flatnonzero: seen.append(len(a)) or plain(a))
    fitted["f"].predict(x)
    assert min(seen) < len(x) / 2 and max(seen) == len(x)


def test_a_batch_walks_each_tree_once(spark, monkeypatch):
    x, y = some()
    model = rows_of(spark, x, y, {"b": np.ones(len(y))}, {"b": trees.Plan(5, 3, True)})["b"]
    batch = np.resize(x, (int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")), x.shape[1]))
    walks, plain = [], trees.Walk.leaves
    monkeypatch.setattr(trees.Walk, "leaves", staticmethod(lambda *a: walks.append(a[2]) or plain(*a)))
    assert np.array_equal(model.predict(batch), np.resize(model.predict(x), len(batch)))
    assert walks[:5] == [len(batch)] * 5 and len(walks) == 10


def matrix_of(spark, x, y):
    rows = [(Vectors.dense(v), int(t)) for v, t in zip(x, y)]
    return spark.createDataFrame(rows, ["features", contracts.TARGET])


def test_same_rows_are_fitted_once_and_others_anew(spark, monkeypatch, tmp_path):
    fits = []
    plain = trees.fit
    monkeypatch.setattr(trees, "fit", lambda *a, **k: fits.append(1) or plain(*a, **k))
    x, y = some()
    first = models.train_models(matrix_of(spark, x, y), SMALL)
    again = models.train_models(matrix_of(spark, x[::-1], y[::-1]).repartition(3), SMALL)
    assert len(fits) == 1
    for name in SMALL.models:
        a, b = (m[name].importances() for m in (first, again))
        assert np.array_equal(a, b)
    changed = x.copy()
    changed[0, 1] += 1
    models.train_models(matrix_of(spark, changed, y), SMALL)
    models.train_models(matrix_of(spark, x, y), models.Settings(**{**vars(SMALL), "seed": 7}))
    assert len(fits) == 3
    path = str(tmp_path / "models")
    for rows in (x, x, changed, changed):
        models.train_models(matrix_of(spark, rows, y), SMALL, path)
    assert len(fits) == 5


def test_linear_model_is_a_column(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([0.0, -1.0],)], "x array<double>")
    found = [r[0] for r in df.select(models.LinearModel((0.5, -1.0), 0.25).probability(F.col("x"))).collect()]
    assert found == pytest.approx([1 / (1 + np.exp(1.25)), 1 / (1 + np.exp(-1.25))])


def test_bound_on_rows_at_any_size(spark, monkeypatch):
    df = spark.range(20_000).select(F.col("id").cast("string").alias(prepare.ROW_ID))
    kept = models.bounded(df, models.Settings(labelled_rows=5000)).count()
    assert 4700 < kept < 5300
    monkeypatch.setattr(type(df), "count", lambda self: 10**16)
    assert models.bounded(df).collect() == []


@pytest.mark.parametrize("share", [0.2, 0.0, 1.0, 0.33])
def test_split_takes_the_exact_share(spark, share, monkeypatch):
    import hashlib
    import math

    rows = [(f"B{i}", int(i % 7 == 0)) for i in range(1000)] + [("B1", 0), (None, 1)]
    df = spark.createDataFrame(rows, f"{prepare.ROW_ID} string, {contracts.TARGET} int")
    monkeypatch.setattr(prepare, "_DIGITS", 1)
    found = {(r[0], r[1]) for r in prepare.stratified_split(df, share).where("split = 'test'").collect()}
    expected = set()
    for label in (0, 1):
        own = sorted((hashlib.md5((f"42:{i}" if i else "42").encode()).hexdigest(), i) for i, y in rows if y == label)
        expected |= {(i, label) for _, i in own[: math.ceil(len(own) * share - 1e-9)]}
    assert found == expected
