import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import quality as Q
from tidemark.plans.views import day, ntz


@pytest.mark.parametrize(
    "age, kind, reason",
    [(17, "Basic", "age"), (18, "Basic", None), (100, "Premium", None), (101, "Basic", "age"), (None, "Basic", "age"),
     (30, "Gold", "subscription_type"), (30, None, "subscription_type"), (30, "Standard", None), (5, "Gold", "age")],
)
def test_subscribers(spark, age, kind, reason):
    df = spark.createDataFrame([(age, kind)], "age int, subscription_type string")
    row = Q.validated(df, Q.subscriber_rules()).first()
    assert (row.reason, row.passed) == (reason, reason is None)


@pytest.mark.parametrize(
    "order_id, amount, date, reason",
    [("a", 1.0, "2024-01-01", None), (None, 1.0, "2024-01-01", "order_id"), ("", 1.0, "2024-01-01", "order_id"),
     ("a", 0.0, "2024-01-01", "amount"), ("a", -1.0, "2024-01-01", "amount"), ("a", None, "2024-01-01", "amount"),
     ("a", 1.0, "2024-01-03", "order_date"), ("a", 1.0, "soon", "order_date"), ("a", 1.0, None, "order_date")],
)
def test_orders(spark, order_id, amount, date, reason):
    df = spark.createDataFrame([(order_id, amount, date)], "order_id string, amount double, order_date string")
    row = Q.with_status(df, ntz("2024-01-02 12:00:00")).first()
    assert (row.reason, row.status) == (reason, "FAILURE" if reason else "SUCCESS")
    assert row.processed_timestamp == "2024-01-02T12:00:00Z"


def issues(df):
    return sorted((r.column or "", r.issue) for r in Q.result_issues(df).collect())


def test_result_issues(spark):
    regions = lambda *v: spark.createDataFrame([(f"r{i}", x) for i, x in enumerate(v)], "region string, revenue string")
    assert issues(regions("1000", "2000", "1500")) == []
    assert issues(regions("1").limit(0)) == [("", "EMPTY_RESULT")]
    assert issues(regions("-500", "1000")) == [("revenue", "NEGATIVE")]
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "value double")
    assert issues(values(1.0, None, None, None)) == [("value", "NULLS")]
    assert issues(values(1.0, None)) == []
    assert issues(values(*[10.0] * 17, 1000.0)) == [("value", "OUTLIER")]
    assert issues(values(*[10.0] * 15, 1000.0)) == []
    assert issues(values(*[10.0] * 17, float("nan"))) == []


def test_profile_is_one_scan_and_handles_every_type(spark, plan):
    df = spark.createDataFrame([(1, True, [1], "2024-01-01"), (2, None, None, None)], "n int, b boolean, a array<int>, d string")
    df = df.withColumn("d", F.to_date("d"))
    assert {r.column: r.null_share for r in Q.profile(df).collect()} == {"n": 0.0, "b": 0.5, "a": 0.5, "d": 0.5}
    assert plan(Q.profile(df)).count("Exchange SinglePartition") <= 1


def test_scorecard(spark):
    cases = {
        "none": [], "schema": ["schema"], "logic": ["logic"], "data": ["data"], "business": ["business"],
        "two": ["logic", "business"], "three": ["schema", "logic", "business"],
    }
    rows = [(run, c, c not in failed) for run, failed in cases.items() for c in Q.CHECK_WEIGHTS]
    df = spark.createDataFrame(rows, "run string, check string, passed boolean")
    got = {r.run: (float(r.confidence), r.recommendation) for r in Q.scorecard(df, ["run"]).collect()}
    assert got == {
        "none": (1.0, "proceed"), "schema": (0.85, "retry"), "logic": (0.7, "retry"), "data": (0.75, "retry"),
        "business": (0.7, "retry"), "two": (0.4, "retry"), "three": (0.25, "escalate"),
    }
    # In binary floats the same subtraction ends below the bound.
    assert 1.0 - 0.3 - 0.3 < 0.4


def test_keys_schema_and_fanout(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert tuple(Q.join_fanout(df, ["k"]).first()) == (2, 1, 2)
    assert {r.column: r.nulls for r in Q.not_null_violations(df, ["k", "v"]).collect()} == {"k": 0, "v": 1}
    expected = StructType.fromDDL("k bigint, w string")
    found = {(r.column, r.problem) for r in Q.schema_differences(df, expected).collect()}
    assert found == {("k", "type"), ("w", "missing"), ("v", "extra")}
    sql = spark.createDataFrame([("SELECT * FROM Orders",)], "sql string")
    assert [r.table_name for r in Q.unreferenced_tables(sql, ["orders", "users"]).collect()] == ["users"]


def test_sanity_and_reconcile(spark):
    df = spark.createDataFrame([(101.0, 1.5, "2024-02-01", " NULL "), (50.0, 2.0, "2024-01-01", "x")], "p double, n double, d string, s string")
    got = Q.sanity_rules(df, day("2024-01-15"), ["p"], ["n"], ["d"], ["s"], 1)
    assert [r.violations for r in got.collect()] == [1, 1, 1, 1, 1]
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "k string, m double")
    b = spark.createDataFrame([("x", 1.0), ("y", 2.5), ("w", 1.0)], "k string, m double")
    assert sorted(r.k for r in Q.reconcile(a, b, ["k"], "m").collect()) == ["w", "y", "z"]


def test_line_arithmetic(spark):
    df = spark.createDataFrame([(1, 19.99, 19.99), (2, 18.99, 37.98), (1, 39.99, 38.99)], "q int, p double, t double")
    assert [r.t for r in Q.line_mismatches(df, "q", "p", "t").collect()] == [38.99]
