"""Record rules, profiles, key checks and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_sum, money
from tidemark.operators import quality as Q
from tidemark.operators.ledger import balances
from tidemark.plans.registry import query
from tidemark.sources.scratch import new_folder
from tidemark.sources.sinks import split_write
from tidemark.plans.views import (
    ORDER_MESSAGES_SQL, SUBSCRIBERS_SQL, day, ntz, order_messages, subscribers,
)

NOW = "2000-01-01 00:00:00"


@query(
    "validate_split",
    f"""
    WITH {SUBSCRIBERS_SQL}
    SELECT customer_id, CASE WHEN age IS NULL OR age < 18 OR age > 100 THEN 'age'
                             WHEN subscription_type IS NULL OR subscription_type NOT IN ('Basic', 'Standard', 'Premium')
                             THEN 'subscription_type' END AS reason,
           COALESCE(age BETWEEN 18 AND 100 AND subscription_type IN ('Basic', 'Standard', 'Premium'), FALSE) AS passed
    FROM subscribers
    """,
)
def validate_split(t):
    """Passed and failed rows go to two folders and are read back from them."""
    path = new_folder(t.spark, "split")
    checked = Q.validated(subscribers(t), Q.subscriber_rules()).select("customer_id", "reason", "passed")
    split_write(checked, F.col("passed"), f"{path}/passed", f"{path}/failed")
    read = t.spark.read.schema("customer_id bigint, reason string, passed boolean").json
    return read(f"{path}/passed").unionByName(read(f"{path}/failed"))


@query(
    "order_rules",
    f"""
    WITH {ORDER_MESSAGES_SQL}
    SELECT order_id, amount, reason, '2000-01-01T00:00:00Z' AS processed_timestamp,
           CASE WHEN reason IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END AS status FROM checked
    """,
)
def order_rules(t):
    checked = Q.with_status(order_messages(t), ntz(NOW))
    return checked.select("order_id", "amount", "reason", "processed_timestamp", "status")


@query(
    "rule_counts",
    f"""
    WITH {ORDER_MESSAGES_SQL}
    SELECT COUNT(CASE WHEN reason IS NULL THEN 1 END) AS success_count, COUNT(reason) AS failure_count FROM checked
    """,
)
def rule_counts(t):
    return Q.status_counts(Q.with_status(order_messages(t), ntz(NOW)))


_LABELLED = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query(
    "null_profile",
    "WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS \"rows\", (COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) AS null_share, "
        f"(COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) > 0.5 AS too_many_nulls FROM d"
        for c in _LABELLED
    ),
)
def null_profile(t):
    rows = t("documents").join(t("labels"), "doc_id", "left").select(*_LABELLED)
    return Q.profile(rows).select("column", "rows", "null_share", "too_many_nulls")


_NUMBERS = ["event_id", "ts_text", "user_id", "event_type", "value", "props", "value_text"]


@query(
    "zscore_profile",
    "WITH e AS (SELECT *, CAST(value AS VARCHAR) AS value_text, CAST(ts AS VARCHAR) AS ts_text FROM events), "
    + ", ".join(
        f"p{i} AS (SELECT AVG(TRY_CAST({c} AS DOUBLE)) AS m, STDDEV_POP(TRY_CAST({c} AS DOUBLE)) AS s, "
        f"MIN(TRY_CAST({c} AS DOUBLE)) AS lo, MAX(TRY_CAST({c} AS DOUBLE)) AS hi FROM e)"
        for i, c in enumerate(_NUMBERS)
    )
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(m, 4) AS mean, ROUND(s, 4) AS deviation, "
        f"ROUND(GREATEST((hi - m) / s, (m - lo) / s), 4) AS max_z, "
        f"COALESCE(GREATEST((hi - m) / s, (m - lo) / s) > 4, FALSE) AS has_outlier FROM p{i}"
        for i, c in enumerate(_NUMBERS)
    ),
)
def zscore_profile(t):
    texts = {"value_text": F.col("value").cast("string"), "ts_text": F.col("ts").cast("string")}
    rows = t("events").withColumns(texts).select(*_NUMBERS)
    rounded = {c: F.round(c, 4) for c in ("mean", "deviation", "max_z")}
    return Q.profile(rows).withColumns(rounded).select("column", "mean", "deviation", "max_z", "has_outlier")


@query(
    "negative_check",
    """
    SELECT 'balance_amount' AS "column", MIN(c_acctbal) < 0 AS has_negative FROM customer
    UNION ALL SELECT 'c_acctbal', FALSE UNION ALL SELECT 'total_price', MIN(o_totalprice) < 0
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    """,
)
def negative_check(t):
    joined = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = joined.select(
        F.col("c_acctbal").alias("balance_amount"), "c_acctbal", F.col("o_totalprice").alias("total_price")
    )
    return Q.profile(rows).select("column", "has_negative")


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",
)
def duplicate_keys(t):
    return Q.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "not_null_check",
    """
    SELECT 'quality' AS "column", COUNT(*) - COUNT(quality) AS nulls FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'lang', COUNT(*) - COUNT(lang) FROM documents
    """,
)
def not_null_check(t):
    rows = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left")
    return Q.not_null_violations(rows, ["quality", "lang"])


@query(
    "join_fanout",
    """
    SELECT MAX(n) AS max_per_key, COUNT(CASE WHEN n > 1 THEN 1 END) AS repeated_keys, COUNT(*) AS distinct_keys
    FROM (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
    """,
)
def join_fanout(t):
    return Q.join_fanout(t("lineitem"), ["l_orderkey"])


@query(
    "sanity_rules",
    """
    SELECT 'percent_range' AS rule, 'l_extendedprice' AS "column", COUNT(CASE WHEN l_extendedprice NOT BETWEEN 0 AND 100 THEN 1 END) AS violations FROM lineitem
    UNION ALL SELECT 'percent_range', 'l_discount', COUNT(CASE WHEN l_discount NOT BETWEEN 0 AND 100 THEN 1 END) FROM lineitem
    UNION ALL SELECT 'whole_count', 'l_quantity', COUNT(CASE WHEN l_quantity <> FLOOR(l_quantity) THEN 1 END) FROM lineitem
    UNION ALL SELECT 'whole_count', 'l_tax', COUNT(CASE WHEN l_tax <> FLOOR(l_tax) THEN 1 END) FROM lineitem
    UNION ALL SELECT 'future_date', 'l_shipdate', COUNT(CASE WHEN CAST(l_shipdate AS DATE) > DATE '2001-01-01' THEN 1 END) FROM lineitem
    UNION ALL SELECT 'null_text', 'l_returnflag', COUNT(CASE WHEN LOWER(TRIM(l_returnflag)) = 'null' THEN 1 END) FROM lineitem
    UNION ALL SELECT 'row_bound', '*', GREATEST(COUNT(*) - 1000, 0) FROM lineitem
    """,
)
def sanity_rules(t):
    return Q.sanity_rules(
        t("lineitem"), day("2001-01-01"), percent=["l_extendedprice", "l_discount"], counts=["l_quantity", "l_tax"],
        dates=["l_shipdate"], texts=["l_returnflag"], max_rows=1000,
    )


@query(
    "dq_scorecard",
    """
    WITH u AS (SELECT user_id, MAX(value) < 300 AS data, BOOL_OR(event_type = 'purchase') AS logic,
                      COUNT(CASE WHEN event_type = 'error' THEN 1 END) < 14 AS business, COUNT(DISTINCT event_type) = 5 AS schema
               FROM events GROUP BY user_id),
    c AS (SELECT user_id, data AND logic AND business AND schema AS all_passed,
                 1.00 - CASE WHEN schema THEN 0.00 ELSE 0.15 END - CASE WHEN logic THEN 0.00 ELSE 0.30 END
                      - CASE WHEN data THEN 0.00 ELSE 0.25 END - CASE WHEN business THEN 0.00 ELSE 0.30 END AS confidence FROM u)
    SELECT user_id, all_passed, CAST(confidence AS DOUBLE) AS confidence,
           CASE WHEN all_passed AND confidence > 0.7 THEN 'proceed' WHEN confidence >= 0.4 THEN 'retry' ELSE 'escalate' END AS recommendation
    FROM c
    """,
)
def dq_scorecard(t):
    kind = F.col("event_type")
    checks = t("events").groupBy("user_id").agg(
        (F.count_distinct("event_type") == 5).alias("schema"),
        F.bool_or(kind == "purchase").alias("logic"),
        (F.max("value") < 300).alias("data"),
        (F.count_if(kind == "error") < 14).alias("business"),
    )
    results = checks.unpivot("user_id", ["schema", "logic", "data", "business"], "check", "passed")
    return Q.scorecard(results, ["user_id"]).withColumn("confidence", F.col("confidence").cast("double"))


@query(
    "metric_reconcile",
    """
    SELECT e.o_orderpriority, expected, supplied, ABS(expected - supplied) AS difference FROM
      (SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(24,6))) AS DOUBLE) AS expected FROM orders GROUP BY 1) e
      FULL JOIN (SELECT o_orderpriority, CAST(SUM(CAST(o_totalprice AS DECIMAL(24,6))) AS DOUBLE) AS supplied FROM orders
                 WHERE o_orderpriority < '4' AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') GROUP BY 1) s
      ON e.o_orderpriority = s.o_orderpriority
    WHERE COALESCE(ABS(expected - supplied) > 0, TRUE)
    """,
)
def metric_reconcile(t):
    orders = t("orders")
    total = lambda df: df.groupBy("o_orderpriority").agg(exact_sum("o_totalprice").alias("revenue"))
    supplied = orders.filter("o_orderpriority < '4' AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')")
    return Q.reconcile(total(orders), total(supplied), ["o_orderpriority"], "revenue")


@query(
    "line_arithmetic",
    """
    SELECT l_returnflag, COUNT(*) AS mismatches FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) <> CAST(l_extendedprice AS DECIMAL(18,2))
    GROUP BY l_returnflag
    """,
)
def line_arithmetic(t):
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    wrong = Q.line_mismatches(lines, "l_quantity", "p_retailprice", "l_extendedprice")
    return wrong.groupBy("l_returnflag").agg(F.count("*").alias("mismatches"))


@query(
    "ledger_balances",
    """
    WITH x AS (SELECT o_orderkey AS seq, o_custkey AS sender, (o_custkey + 7) % (SELECT COUNT(*) FROM customer) AS receiver,
                      CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
    p AS (SELECT seq, sender AS account, -amount AS delta, 0 AS leg FROM x
          UNION ALL SELECT seq, receiver, amount, 1 FROM x),
    r AS (SELECT *, SUM(delta) OVER (PARTITION BY account ORDER BY seq, leg ROWS UNBOUNDED PRECEDING) AS balance FROM p)
    SELECT account, COUNT(*) AS postings, CAST(SUM(delta) AS DOUBLE) AS end_balance, CAST(MIN(balance) AS DOUBLE) AS lowest_balance,
           MIN(CASE WHEN balance < 0 THEN seq END) AS first_overdraft
    FROM r GROUP BY account
    """,
)
def ledger_balances(t):
    customers = t("customer").agg(F.count("*")).scalar()
    transfers = t("orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("sender"),
        ((F.col("o_custkey") + 7) % customers).alias("receiver"),
        money("o_totalprice").alias("amount"),
    )
    as_double = {c: F.col(c).cast("double") for c in ("end_balance", "lowest_balance")}
    return balances(transfers).withColumns(as_double)
