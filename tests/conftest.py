from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from a DDL schema and tuples."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)
