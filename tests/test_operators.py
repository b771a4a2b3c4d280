"""Ordering, windows, sets and aggregates against brute force, hot keys included."""

import statistics
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import sets as S
from tidemark.operators import windows as W
from tidemark.operators.ledger import balances
from tidemark.operators.ordering import exact_median, number_rows, running_total, sequence_block

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(spark, n=3000):
    """Rows of which key 0 holds more than a third and NULL some."""
    return spark.range(n).select(
        F.when(F.col("id") % 5 < 2, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 11).alias("k"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 37) % 101 - 50).alias("v"),
    )


@pytest.mark.parametrize("levels", [[], [("_b", 100)], [("_a", 700), ("_b", 50)]])
def test_running_total_matches_one_window(spark, levels):
    df = skewed(spark)
    steps = [(name, sequence_block("seq", size)) for name, size in levels]
    got = running_total(df, ["k"], steps, ["seq"], F.col("v"), "total")
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("total", F.sum("v").over(w))
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_running_total_without_keys(spark):
    got = running_total(skewed(spark, 500), [], [("_b", sequence_block("seq", 64))], ["seq"], F.lit(1), "n")
    assert [r.n for r in got.orderBy("seq").collect()] == list(range(1, 501))


@pytest.mark.parametrize("order", [["k", "seq"], None])
def test_numbers_are_dense(spark, order):
    numbered = number_rows(skewed(spark).repartition(5), "n", order, start=10).collect()
    assert sorted(r.n for r in numbered) == list(range(10, 3010))
    if order:
        by_number = sorted(numbered, key=lambda r: r.n)
        keys = [(r.k is not None, r.k or 0, r.seq) for r in by_number]
        assert keys == sorted(keys)


def test_numbers_of_an_empty_frame(spark):
    assert number_rows(skewed(spark).limit(0), "n", ["seq"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_median_with_a_hot_value(spark, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    expected = statistics.median(r.v for r in df.collect())
    assert exact_median(df, "v").first()[0] == expected


INF = float("inf")


@pytest.mark.parametrize("values", [
    [], [3.0], [-1.0, 1.0], [0.0, -0.0, 5e-324, -5e-324], [1e308, -1e308, 1e-300, 2e-300], [-INF, -INF, 2.0, INF],
    [1.0 + i * 2.0**-52 for i in range(1001)], [1.0 + i * 2.0**-50 for i in range(6)] + [9e18] * 3, [-7.5] * 50 + [2.0] * 50,
])
def test_median_by_counting(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    expected = statistics.median(values) if values else None
    assert exact_median(df, "v").first()[0] == expected


def test_median_of_other_types(spark):
    df = spark.range(2**62, 2**62 + 5).select("id", (F.col("id") % 7).cast("decimal(20,3)").alias("d"), F.lit(float("nan")).alias("x"))
    middle = statistics.median(r.d for r in df.collect())
    assert exact_median(df, "id").first()[0] == float(2**62 + 2)
    assert exact_median(df, "d").first()[0] == middle
    assert str(exact_median(df, "x").first()[0]) == "nan"


def test_median_needs_no_sort_and_no_copy(spark, plan):
    text = plan(W.magnitude_outliers(spark.range(1000).selectExpr("id", "id * 1.5D AS v"), "v"))
    assert "rangepartitioning" not in text.lower() and "Sort" not in text and "parquet" not in text


def test_magnitude_outliers(spark):
    df = spark.createDataFrame([(i, 10.0) for i in range(9)] + [(9, 100.0), (10, 1.0), (11, 99.0)], "id int, v double")
    far = W.magnitude_outliers(df, "v").select("id", "direction").collect()
    assert sorted(tuple(r) for r in far) == [(9, "above"), (10, "below")]


def test_top_keeps_ties_and_latest_does_not(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, 1)], "g string, id int, v int")
    top = W.top_per_group(df, ["g"], [F.desc("v")])
    assert sorted(r.id for r in top.collect()) == [1, 2, 4]
    last = W.latest_per_key(df, ["g"], [F.desc("v"), F.desc("id")])
    assert sorted(r.id for r in last.collect()) == [2, 4]


def test_growth_is_null_without_or_with_zero_previous(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 10.0)], "g string, p int, v double")
    assert [r.growth_pct for r in W.period_growth(df, ["g"], "p", "v").orderBy("p").collect()] == [None, None, 100.0]


def test_named_aggregates(spark):
    df = skewed(spark, 20)
    assert A.aggregate(df, [], [("v", "sum"), ("k", "count")]).columns == ["sum(v)", "count(k)"]
    assert A.aggregate(df, [], [("k", "count")]).count() == 1
    assert A.aggregate(df.limit(0), ["k"], [("v", "max")]).count() == 0
    with pytest.raises(ValueError):
        A.aggregate(df, [], [("v", "system")])


def test_conversion_of_a_device_without_carts(spark):
    df = spark.createDataFrame([("a", "o"), ("a", "c"), ("a", "c"), ("b", "o")], "d string, e string")
    out = A.conversion(df, ["d"], F.col("e") == "o", F.col("e") == "c").orderBy("d").collect()
    assert [tuple(r) for r in out] == [("a", 1, 2, 0.5), ("b", 1, 0, None)]


def test_share_adds_up(spark):
    shares = A.with_share(skewed(spark).groupBy("k").agg(F.count("*").alias("n")), "n")
    assert abs(sum(r.share for r in shares.collect()) - 1) < 1e-12


def test_sets(spark):
    a = spark.createDataFrame([(1, 0.5)], "id int, score double")
    b = spark.createDataFrame([(2,), (3,)], "id int")
    assert S.union_sources([a, b, b]).count() == 5
    assert [r.id for r in S.merge_top([b, a], 2, ["id"]).collect()] == [1, 2]
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-04",), (None,)], "d string")
    assert [str(r.day) for r in S.missing_days(days, "d").orderBy("day").collect()] == ["2024-01-02", "2024-01-03"]


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    right = spark.createDataFrame([(2, "c"), (3, "d")], "id int, y string")
    assert [J.join_by_name(left, right, ["id"], k).count() for k in ("INNER", "left", "RIGHT", "FULL")] == [1, 2, 2, 3]
    clicks = spark.createDataFrame([("google",), ("referral",)], "traffic_source string")
    found = {r.traffic_source: r.campaign_type for r in J.enrich_campaign(clicks).collect()}
    assert found == {"google": "paid_search", "referral": None}


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(1, 100)), min_size=1, max_size=30
    )
)
def test_ledger_matches_a_serial_book(spark, moves):
    book, low, overdraft, count = defaultdict(int), {}, {}, defaultdict(int)
    for seq, (sender, receiver, amount) in enumerate(moves):
        for account, delta in ((sender, -amount), (receiver, amount)):
            book[account] += delta
            count[account] += 1
            low[account] = min(low.get(account, book[account]), book[account])
            if book[account] < 0:
                overdraft.setdefault(account, seq)
    df = spark.createDataFrame(
        [(i, *m) for i, m in enumerate(moves)], "seq long, sender int, receiver int, amount int"
    )
    got = {r.account: (r.postings, r.end_balance, r.lowest_balance, r.first_overdraft) for r in balances(df).collect()}
    assert got == {a: (count[a], book[a], low[a], overdraft.get(a)) for a in book}
