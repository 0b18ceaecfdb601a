from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import edges  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(edges.documents(), edges.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
