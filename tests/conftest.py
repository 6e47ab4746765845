import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from shelfsight.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), …)``"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
