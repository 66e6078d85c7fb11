"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from depotstar.plans.oracle import ORACLE  # noqa: E402
from depotstar.plans.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(queries()[name](spark, FOLDER), con, oracle_sql()[name]) == "ok"


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["department_name", "year", "lines", "quantity", "sales", "discount", "profit"]
    assert df.count() > 0
