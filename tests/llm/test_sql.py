"""The queries that SQL can express, against DuckDB."""

import pytest

from compare import difference, duck
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), duck(folder), SQL[name]) is None
