from lastro.catalog import queries


def test_each_query_fits_by_itself_unless_a_fit_is_passed(book, monkeypatch):
    fits = []
    monkeypatch.setattr(queries, "fit_models", lambda b: fits.append(b.folder) or (None, None, None, b.spark.range(len(fits))))
    monkeypatch.setattr(queries.models, "comparison", lambda tested: tested)
    run = queries.QUERIES["model_comparison"]
    assert [run(book.spark, book.folder).count() for _ in range(2)] == [1, 2]
    assert queries.model_comparison(book, queries.fit_models(book)).count() == 3
    assert len(fits) == 3


def test_lines_are_read_once_and_model_inputs_written_once(spark, folder, monkeypatch):
    from lastro.catalog.views import Book
    from lastro.ml import models

    own = Book(spark, folder)
    for table in (own.features, own.scored, own.raw_scored):
        assert not [f for f in table.inputFiles() if "lineitem" in f or "orders" in f]
    written = {}
    plain = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, name, *by: written.setdefault(name, df.columns) and plain(df, name, *by))
    small = models.Settings(models=(models.LOGISTIC,), logistic_iterations=20)
    train = models.train_models
    monkeypatch.setattr(models, "train_models", lambda rows: train(rows, small))
    table, fitted, trained, _ = queries.fit_models(own)
    assert set(written) == {"features", "matrix", "metrics"}
    assert set(written["features"]) == {*queries.prepare.select_features(own.features).columns, *models.published_columns(own.features)}
    assert set(written["features"]) < set(own.features.columns)
    whole, pruned = (models.score_dataset(t, trained[models.LOGISTIC], fitted) for t in (own.features, table))
    assert whole.columns == pruned.columns and whole.exceptAll(pruned).count() == 0 == pruned.exceptAll(whole).count()
