"""Join keys are columns of one name whose values the other table has."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.join_keys import inferred_keys


def bare(column):
    return column.partition("_")[2]


def frames(spark):
    return {
        "shop": spark.range(3000).selectExpr("id AS s_id", "concat('n', id) AS s_name", "concat('c', id) AS s_comment", "array(id) AS s_list"),
        "sale": spark.range(9000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id % 3000 END AS l_id", "concat('x', id) AS l_name",
            "CAST(NULL AS string) AS l_comment", "array(id) AS l_list",
        ),
        "visit": spark.range(4000).selectExpr("id * 2 AS v_id", "cast(id AS string) AS v_comment"),
    }


@pytest.mark.parametrize("sample", [200, 100_000])
def test_values_decide_between_columns_of_one_name(spark, sample):
    found = inferred_keys(frames(spark), bare, sample)
    assert [tuple(r) for r in found.collect()] == [("sale", "l_id", "shop", "s_id")]


def test_share_of_values_that_must_be_there(spark):
    found = {(r.child_table, r.parent_table) for r in inferred_keys(frames(spark), bare, 100_000, 0.3).collect()}
    assert ("visit", "shop") in found and ("shop", "visit") in found and ("sale", "shop") in found


def test_tables_without_pairs_or_rows(spark):
    tables = frames(spark)
    assert inferred_keys({"shop": tables["shop"]}, bare).count() == 0
    empty = inferred_keys({name: df.limit(0) for name, df in tables.items()}, bare)
    assert (empty.count(), empty.columns) == (0, ["child_table", "child_column", "parent_table", "parent_column"])


def test_other_types_do_not_pair(spark):
    tables = {"a": spark.range(9).selectExpr("id AS a_k"), "b": spark.range(9).select(F.col("id").cast("string").alias("b_k")), "c": spark.range(9).selectExpr("cast(id AS int) AS c_k")}
    assert {(r.child_table, r.parent_table) for r in inferred_keys(tables, bare).collect()} == {("a", "c"), ("c", "a")}
