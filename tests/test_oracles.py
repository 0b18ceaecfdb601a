"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from checks.compare import differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert differences(spark, SF_DIR, name) == []
