import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lastro.session import local_session  # noqa: E402

DATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="lastro-tests", memory="6g")


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("test data not present")
    return str(DATA)


@pytest.fixture(scope="session")
def book(spark, folder):
    from lastro.catalog.views import Book

    return Book(spark, folder)
