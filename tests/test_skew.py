"""Every registered query on tables with hot keys, hot dates and NULLs in keys and measures."""

import duckdb
import pytest

from compare import difference, duck
import tidemark.plans.queries  # noqa: F401
from tidemark.plans.registry import QUERIES, SQL
from tidemark.sources.tables import SCHEMAS

SOURCE = "/root/testdata/sf0.001"
CHANGES = {
    "orders": """* REPLACE (
        CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS o_custkey,
        CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '1997-02-03' ELSE o_orderdate END AS o_orderdate)""",
    "lineitem": """* REPLACE (
        CAST(CASE WHEN l_linenumber = 1 THEN 11 ELSE l_orderkey END AS BIGINT) AS l_orderkey,
        CAST(CASE WHEN l_orderkey % 3 = 0 THEN 5 WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_partkey END AS BIGINT) AS l_partkey)""",
    "events": """* REPLACE (
        CAST(CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 29 = 0 THEN NULL ELSE user_id END AS BIGINT) AS user_id,
        CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS event_type,
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE value END AS value)""",
    "customer": """* REPLACE (
        CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment)""",
    "part": "* REPLACE (CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS p_type)",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in SCHEMAS:
        columns = CHANGES.get(name, "*")
        con.execute(f"COPY (SELECT {columns} FROM '{SOURCE}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, folder, con, name):
    problem = difference(QUERIES[name](spark, folder), con, SQL[name])
    assert problem in (None, "both sides are empty"), problem
