"""Every registered query that has SQL, against DuckDB on the smallest data folder."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from lastro.catalog.oracle import oracle_statements  # noqa: E402
from lastro.catalog.queries import BUILDERS  # noqa: E402
from tools import compare  # noqa: E402

STATEMENTS = oracle_statements()


@pytest.fixture(scope="module")
def engine(folder):
    return compare.connect(folder)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, folder):
    assert entry.entry(spark).first().total_boletos == 1473


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(book, engine, name):
    df = BUILDERS[name](book)
    rows = [tuple(r) for r in df.collect()]
    cursor = engine.execute(STATEMENTS[name])
    columns = [d[0] for d in cursor.description]
    assert compare.difference(df.columns, rows, columns, cursor.fetchall()) is None
