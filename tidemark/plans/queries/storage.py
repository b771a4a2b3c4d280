"""Sources, sinks and streams as round trips: tables are written in a form, and read back from it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import dimensions as D
from tidemark.operators import metrics as M
from tidemark.operators.quality import result_issues
from tidemark.operators.sets import union_sources
from tidemark.operators.windows import latest_per_key
from tidemark.plans.registry import query
from tidemark.plans.views import SUBSCRIBERS_SQL, ntz, subscribers
from tidemark.sources import scans, sinks
from tidemark.sources.quarantine import load_or_quarantine, replay
from tidemark.sources.scratch import new_folder, written
from tidemark.streaming import jobs
from tidemark.streaming.sources import record_stream

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
_CUSTOMERS = "c_custkey bigint, c_name string, c_acctbal double"
_CUSTOMERS_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer"


def _orders(t):
    return t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _customers(t):
    return t("customer").select("c_custkey", "c_name", "c_acctbal")


@query("csv_roundtrip", _ORDERS_SQL)
def csv_roundtrip(t):
    """CSV export with a header, read back by a declared schema."""
    path = new_folder(t.spark, "csv")
    sinks.export_csv(_orders(t), path)
    return scans.csv_with_header(t.spark, path, _ORDERS)


@query("json_lines_roundtrip", _ORDERS_SQL)
def json_lines_roundtrip(t):
    path = new_folder(t.spark, "json")
    _orders(t).write.json(path)
    return scans.json_lines(t.spark, path, _ORDERS)


@query("json_array_roundtrip", _CUSTOMERS_SQL)
def json_array_roundtrip(t):
    """Files of one JSON array each, of a thousand records at most."""
    path = new_folder(t.spark, "arrays")
    record = F.struct("c_custkey", "c_name", "c_acctbal")
    block = F.floor(F.col("c_custkey") / 1000).alias("block")
    arrays = _customers(t).groupBy(block).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("block").text(path)
    return scans.json_array(t.spark, path, _CUSTOMERS).select("c_custkey", "c_name", "c_acctbal")


@query("pattern_scan", _ORDERS_SQL)
def pattern_scan(t):
    """Files of a folder by name pattern."""
    path = new_folder(t.spark, "pattern")
    _orders(t).write.parquet(path)
    return scans.from_files(t.spark, path, "part-*", "parquet", _ORDERS)


@query("stage_roundtrip", _ORDERS_SQL)
def stage_roundtrip(t):
    """Untyped stage files by column position, cast on the way."""
    path = new_folder(t.spark, "stage")
    sinks.export_csv(_orders(t), path)
    staged = scans.stage_files(t.spark, path, 4)
    kinds = ("bigint", "bigint", "string", "double")
    return staged.select(*[F.col(f"c{i}").cast(k).alias(n) for i, (n, k) in enumerate(zip(_orders(t).columns, kinds, strict=True), 1)])


@query("discovered_roundtrip", _CUSTOMERS_SQL)
def discovered_roundtrip(t):
    """Comma and pipe files in one folder; separators and types are found per file."""
    path = new_folder(t.spark, "discovered")
    rows = _customers(t)
    odd = F.col("c_custkey") % 2 == 1
    rows.filter(odd).write.option("header", True).csv(path)
    rows.filter(~odd).write.mode("append").option("header", True).option("sep", "|").csv(path)
    found = scans.discovered_files(t.spark, path)
    return found.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("layer_overwrite", _CUSTOMERS_SQL)
def layer_overwrite(t):
    """A layer written twice holds the rows of the second write only."""
    path = new_folder(t.spark, "layer")
    sinks.overwrite_layer(_customers(t).withColumn("c_name", F.lit("old")), path)
    return sinks.overwrite_layer(_customers(t), path)


@query("compacted_puts", "SELECT user_id, MAX(event_id) AS event_id FROM events GROUP BY user_id")
def compacted_puts(t):
    """Two put batches folded into one base table, which is read back."""
    path, base = new_folder(t.spark, "puts"), new_folder(t.spark, "base")
    by_user = t("events").groupBy("user_id")
    sinks.put_batch(by_user.agg(F.min("event_id").alias("event_id")), path, 0)
    sinks.put_batch(by_user.agg(F.max("event_id").alias("event_id")), path, 1)
    return sinks.compact_puts(t.spark, path, "user_id bigint, event_id bigint", ["user_id"], base)


def _drained(*running):
    for one in running:
        one.awaitTermination()


@query("record_stream", "SELECT event_id, user_id, event_type FROM events")
def record_stream_query(t):
    """Event lines through a file stream into a file sink."""
    path = new_folder(t.spark, "records")
    t("events").select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value")).write.text(f"{path}/in")
    rows = record_stream(t.spark, f"{path}/in", "event_id bigint, user_id bigint, event_type string")
    _drained(rows.writeStream.format("parquet").option("checkpointLocation", f"{path}/cp").trigger(**jobs.AVAILABLE).start(f"{path}/out"))
    return t.spark.read.schema("event_id bigint, user_id bigint, event_type string").parquet(f"{path}/out")


@query(
    "upsert_stream",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, UPPER(c_name) AS name, CAST(FLOOR(ABS(c_acctbal) / 100.0::DOUBLE) AS INTEGER) AS age,
           FLOOR(ABS(c_acctbal) / 100.0::DOUBLE) >= 18 AS "isAdult"
    FROM customer
    """,
)
def upsert_stream(t):
    """Person messages as keyed puts; the second file of the queue replaces the first."""
    path = new_folder(t.spark, "persons")
    age = F.floor(F.abs("c_acctbal") / 100.0).cast("int")
    body = lambda name: F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), name.alias("name"), age.alias("age")))
    run = lambda: _drained(jobs.person_stream(t.spark, f"{path}/in", f"{path}/table", f"{path}/cp"))
    for name in (F.lit("first"), F.col("c_name")):
        t("customer").select(body(name).alias("body")).write.mode("append").json(f"{path}/in")
        run()
    return sinks.read_puts(t.spark, f"{path}/table", "id string, name string, age int, isAdult boolean", ["id"])


@query(
    "layered_stream",
    f"""
    WITH {SUBSCRIBERS_SQL}
    SELECT subscription_type, COUNT(*) AS customers FROM subscribers
    WHERE age BETWEEN 18 AND 100 AND subscription_type IN ('Basic', 'Standard', 'Premium') GROUP BY subscription_type
    """,
)
def layered_stream(t):
    """Landing documents to the pass layer, and totals over it."""
    path = new_folder(t.spark, "layers")
    rows = subscribers(t).select(
        F.col("customer_id").cast("string").alias("customer_id"), F.lit("n").alias("name"), "age", "subscription_type",
        F.lit("2024-01-01").alias("signup_date"), F.lit(True).alias("active"),
    )
    block = F.floor(F.col("customer_id").cast("bigint") / 1000).alias("block")
    arrays = rows.groupBy(block).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.write.partitionBy("block").text(f"{path}/in")
    _drained(*jobs.validate_stream(t.spark, f"{path}/in", f"{path}/pass", f"{path}/fail", f"{path}/cp"))
    _drained(jobs.subscription_metrics_stream(t.spark, f"{path}/pass", f"{path}/totals", f"{path}/cp2"))
    return sinks.read_newest(t.spark, f"{path}/totals", "subscription_type string, customers bigint")


@query("bulk_load_stream", _CUSTOMERS_SQL)
def bulk_load_stream(t):
    """Stage files loaded once each by position."""
    path = new_folder(t.spark, "bulk")
    sinks.export_csv(_customers(t), f"{path}/in")
    columns = [("c1", "bigint", "c_custkey"), ("c2", "string", "c_name"), ("c3", "double", "c_acctbal")]
    for _ in range(2):
        _drained(jobs.bulk_load_stream(t.spark, f"{path}/in", columns, f"{path}/out", f"{path}/cp"))
    return t.spark.read.schema(_CUSTOMERS).parquet(f"{path}/out")


@query(
    "scd1_repeated_keys",
    """
    SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS last_order FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    UNION ALL
    SELECT c_custkey, 'none' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    """,
)
def scd1_repeated_keys(t):
    """Every order is a row of the batch, so a buyer's key comes many times; the newest order counts.

    Orders without a buyer are one group: the newest of them is inserted.
    """
    target = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("none").alias("last_order"), ntz("2024-01-01 00:00:00").alias("at"))
    orders = t("orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("last_order"), "o_orderdate", "o_orderkey")
    nobody = latest_per_key(orders.filter("o_custkey IS NULL"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    batch = orders.filter("o_custkey IS NOT NULL").unionByName(nobody)
    merged = D.scd1_merge(
        target, batch, "o_custkey", ["last_order"], "at", ntz("2024-06-01 00:00:00"), newest=[F.desc("o_orderdate"), F.desc("o_orderkey")]
    )
    return merged.select("o_custkey", "last_order")


@query(
    "metric_store",
    """
    SELECT name, expression FROM (
      SELECT LOWER(p_type) AS name, p_name AS expression, ROW_NUMBER() OVER (PARTITION BY LOWER(p_type) ORDER BY p_partkey DESC) AS rn
      FROM part WHERE p_type IS NOT NULL) WHERE rn = 1
    """,
)
def metric_store(t):
    """Definitions by part type, many to a name and in mixed case; the last one of each counts."""
    changes = t("part").filter("p_type IS NOT NULL").select(
        F.when(F.col("p_partkey") % 2 == 0, F.lower("p_type")).otherwise(F.col("p_type")).alias("name"), F.col("p_name").alias("expression"),
        F.col("p_partkey").alias("seq"),
    )
    store = t.spark.createDataFrame([], "name string, expression string, last_updated string")
    return M.upsert_metrics(store, changes, F.lit("2024-06-01"), [F.desc("seq")]).select("name", "expression")


@query(
    "split_stream",
    """
    SELECT status, COUNT(*) AS sink_rows, COUNT(*) AS counted FROM (
      SELECT CASE WHEN o_totalprice > 0 AND o_orderdate <= TIMESTAMP '1997-06-01' THEN 'SUCCESS' ELSE 'FAILURE' END AS status FROM orders)
    GROUP BY status
    """,
)
def split_stream(t):
    """Order messages in batches to one sink folder per status; the counters are what the batches observed."""
    path = new_folder(t.spark, "split-stream")
    body = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("amount"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date")))
    for part in range(2):  # two deliveries, hence two batches at least
        t("orders").filter(F.pmod("o_orderkey", F.lit(2)) == part).select(body.alias("body")).write.mode("append").json(f"{path}/in")
        start = lambda: jobs.observed_order_stream(t.spark, f"{path}/in", f"{path}/out", f"{path}/cp", ntz("1997-06-01 00:00:00"))
        jobs.counted_run(t.spark, start, jobs.ORDER_COUNTERS, f"{path}/counters")
    rows = t.spark.read.schema("order_id string, status string").json(f"{path}/out").groupBy("status").agg(F.count("*").alias("sink_rows"))
    counters = t.spark.read.schema("success_count bigint, failure_count bigint").json(f"{path}/counters")
    totals = counters.agg(F.sum("success_count").alias("SUCCESS"), F.sum("failure_count").alias("FAILURE"))
    counted = totals.unpivot([], ["SUCCESS", "FAILURE"], "_status", "counted")
    return rows.join(counted, F.col("status") == F.col("_status")).select("status", "sink_rows", "counted")


@query(
    "quarantine_replay",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'refused' WHEN o_orderkey % 7 = 0 THEN 'replayed' ELSE 'loaded' END AS state,
           CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def quarantine_replay(t):
    """Orders as JSON lines, some cut short, some with a word for the price: each is loaded, replayed or still refused."""
    path = new_folder(t.spark, "lines")
    line = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))
    worded = F.to_json(F.struct("o_orderkey", F.lit("none").alias("o_totalprice")))
    cut = F.substring(line, F.lit(1), F.length(line) - 1)
    damaged = F.when(F.col("o_orderkey") % 11 == 0, worded).when(F.col("o_orderkey") % 7 == 0, cut).otherwise(line)
    _orders(t).select(damaged.alias("value")).write.text(path)
    loaded, refused = load_or_quarantine(t.spark, path, _ORDERS, "json")
    replayed, left = replay(refused, lambda r: F.when(r.endswith("}"), r).otherwise(F.concat(r, F.lit("}"))), _ORDERS)
    key = F.regexp_extract("record", '"o_orderkey":([0-9]+)', 1).cast("bigint")
    states = [
        loaded.withColumn("state", F.lit("loaded")), replayed.withColumn("state", F.lit("replayed")),
        left.select(key.alias("o_orderkey"), F.lit("refused").alias("state")),
    ]
    every = states[0].unionByName(states[1]).unionByName(states[2], allowMissingColumns=True)
    return every.select("o_orderkey", "state", "o_custkey", "o_totalprice")


@query(
    "table_loads",
    """
    WITH c AS (SELECT COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys FROM customer)
    SELECT 'copied twice' AS step, 2 * n AS n, 2 * keys AS keys FROM c UNION ALL SELECT 'appended twice', 4 * n, 4 * keys FROM c
    UNION ALL SELECT 'overwritten twice', n, keys FROM c UNION ALL SELECT 'replaced', n, keys FROM c
    UNION ALL SELECT 'truncated', 0, NULL
    """,
)
def table_loads(t):
    """A catalog table through COPY, append, overwrite, replacement with another schema, and truncation."""
    name = f"loads_{uuid.uuid4().hex}"
    rows = _customers(t)
    path = new_folder(t.spark, "copy")
    sinks.export_csv(rows, path)
    staged = scans.stage_files(t.spark, path, 3)
    columns = [("c1", "bigint", "c_custkey"), ("c2", "string", "c_name"), ("c3", "double", "c_acctbal")]
    steps = []

    def state(step: str, load, *args) -> None:
        load(*args)
        now = t.spark.table(name).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
        steps.append(written(now.select(F.lit(step).alias("step"), "n", "keys"), "state"))

    def twice(load, *args) -> None:
        load(*args)
        load(*args)

    state("copied twice", twice, sinks.copy_into, staged, columns, name)
    state("appended twice", twice, sinks.insert_append, rows, name)
    state("overwritten twice", twice, sinks.insert_overwrite, rows, name)
    state("replaced", sinks.create_or_replace, rows.select("c_custkey"), name)
    state("truncated", sinks.truncate, t.spark, name)
    t.spark.sql(f"DROP TABLE {name}")
    return union_sources(steps)


@query("single_csv", "SELECT c_nationkey, COUNT(*) AS customers FROM customer GROUP BY c_nationkey")
def single_csv(t):
    """A small aggregate as one file without a header, read back."""
    path = new_folder(t.spark, "single")
    sinks.export_single_csv(t("customer").groupBy("c_nationkey").agg(F.count("*").alias("customers")), path)
    return t.spark.read.schema("c_nationkey int, customers bigint").csv(path)


@query("catalog_roundtrip", _CUSTOMERS_SQL)
def catalog_roundtrip(t):
    """Customers as a catalog table, read by name."""
    name = f"customers_{uuid.uuid4().hex}"
    sinks.create_or_replace(_customers(t), name)
    kept = written(scans.catalog_table(t.spark, "default", name), "catalog")
    t.spark.sql(f"DROP TABLE {name}")
    return kept


@query("stage_listing", "SELECT DISTINCT c_nationkey, TRUE AS has_files FROM customer")
def stage_listing(t):
    """Files of a stage with a folder per nation, listed without reading them."""
    path = new_folder(t.spark, "listing")
    t("customer").select("c_nationkey", "c_name").write.partitionBy("c_nationkey").csv(path)
    listed = scans.stage_listing(t.spark, path, "*.csv")
    nation = F.regexp_extract("path", "/c_nationkey=([0-9-]+)/", 1).cast("int")
    return listed.groupBy(nation.alias("c_nationkey")).agg((F.sum("size") > 0).alias("has_files"))


@query("empty_result", """SELECT CAST(NULL AS VARCHAR) AS "column", 'EMPTY_RESULT' AS issue""")
def empty_result(t):
    """A filter that no order passes is reported as an empty result."""
    return result_issues(t("orders").filter("o_totalprice < -1e18"))


@query(
    "metric_feedback",
    """
    WITH f AS (SELECT LOWER(p_type) AS name, p_partkey, CASE p_size % 3 WHEN 0 THEN 'correct' WHEN 1 THEN 'incorrect' END AS verdict FROM part),
    l AS (SELECT name, ARG_MAX(verdict, p_partkey) AS verdict FROM f WHERE verdict IS NOT NULL GROUP BY name)
    SELECT DISTINCT f.name, COALESCE(l.verdict = 'correct', FALSE) AS approved,
           CASE l.verdict WHEN 'correct' THEN 'user_feedback' WHEN 'incorrect' THEN 'needs_review' ELSE 'auto_suggested' END AS updated_by
    FROM f LEFT JOIN l ON f.name = l.name WHERE f.name IS NOT NULL
    """,
)
def metric_feedback(t):
    """Every part type suggested as a metric, then judged by a feedback entry per part; the last usable one counts."""
    store = t.spark.createDataFrame([], "name string, expression string, approved boolean, updated_by string, last_updated string")
    named = t("part").filter("p_type IS NOT NULL")
    suggested = named.select(F.col("p_type").alias("name"), F.concat(F.lit("MAX("), "p_name", F.lit(")")).alias("expression"), F.col("p_partkey").alias("seq"))
    store = M.suggest_metrics(store, suggested, F.lit("2024-06-01"), [F.asc("seq")])
    word = F.when(F.col("p_size") % 3 == 0, "Correct").when(F.col("p_size") % 3 == 1, "INCORRECT").otherwise("maybe")
    feedback = named.select(F.col("p_partkey").alias("seq"), F.col("p_type").alias("metric"), word.alias("feedback"))
    return M.apply_feedback(store, feedback).select("name", "approved", "updated_by")
