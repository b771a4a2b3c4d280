"""Every registered query against DuckDB on the smallest driver tables."""

import pytest

from __spark_entry__ import entry
from compare import difference, duck
import tidemark.plans.queries  # noqa: F401
from tidemark.plans.registry import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem = difference(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert problem in (None, "both sides are empty"), problem


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5
    assert [r.revenue for r in rows] == sorted((r.revenue for r in rows), reverse=True)
