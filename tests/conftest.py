import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from webgrain.session import build_session  # noqa: E402


# made here because the test modules build columns when they are imported
session = build_session("local[4]", 4, "tests", memory="4g")


@pytest.fixture(scope="session")
def spark():
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Value of column expressions over a one-column table of given values."""

    def run(values, schema, *columns):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
        return [tuple(r)[1:] for r in rows.select("i", *columns).orderBy("i").collect()]

    return run
