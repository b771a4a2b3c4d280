"""Roles of the driver tables, as frames and as the same SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import Tables

# Names assigned to derived codes.
DEVICES = ["mobile", "desktop", "tablet"]
SOURCES = ["email", "facebook", "google", "twitter", "referral"]

NET_SQL = "CAST(l_extendedprice * (1.0::DOUBLE - l_discount) AS DECIMAL(24,6))"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def picked(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def prop_k() -> Column:
    return F.from_json("props", "k bigint")["k"]


def clickstream(t: Tables) -> DataFrame:
    return t("events").withColumn("_k", prop_k()).select(
        "event_id",
        picked(DEVICES, F.col("user_id") % 3).alias("device"),
        F.struct((F.col("value") / 8).alias("price"), F.col("_k").alias("unit")).alias("ecommerce"),
        F.col("event_type").alias("event_name"),
        picked(SOURCES, F.col("_k") % 5).alias("traffic_source"),
    )


_K_SQL = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"
CLICKSTREAM_SQL = f"""clickstream AS (
  SELECT event_id,
         (['mobile', 'desktop', 'tablet'])[CAST(user_id % 3 AS INTEGER) + 1] AS device,
         value / 8 AS price, {_K_SQL} AS unit, event_type AS event_name,
         (['email', 'facebook', 'google', 'twitter', 'referral'])[CAST({_K_SQL} % 5 AS INTEGER) + 1] AS traffic_source
  FROM events)"""


def device_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t("events").withColumn("_k", prop_k()).select(
        "event_id",
        F.when(kind == "purchase", "active").when(kind == "view", "inactive")
        .when(kind == "error", "faulty").otherwise("other").alias("status"),
        F.when(kind == "click", "alert").when(kind == "view", "heartbeat")
        .when(kind == "purchase", "sensor_reading").otherwise("other").alias("event_type"),
        F.struct(
            ((F.col("_k") - 50) * 1.25).alias("latitude"), (F.col("value") - 100.0).alias("longitude")
        ).alias("location"),
    )


DEVICE_EVENTS_SQL = f"""device_events AS (
  SELECT event_id,
         CASE event_type WHEN 'purchase' THEN 'active' WHEN 'view' THEN 'inactive'
                         WHEN 'error' THEN 'faulty' ELSE 'other' END AS status,
         CASE event_type WHEN 'click' THEN 'alert' WHEN 'view' THEN 'heartbeat'
                         WHEN 'purchase' THEN 'sensor_reading' ELSE 'other' END AS event_type,
         ({_K_SQL} - 50) * CAST(1.25 AS DOUBLE) AS latitude, value - 100.0::DOUBLE AS longitude
  FROM events)"""


def placed_orders(t: Tables, region: bool = False) -> DataFrame:
    """Orders with their buyer and the buyer's place.

    Each dimension is joined as a plain scan, so its size is known when Spark
    chooses the join, and lines meet orders last: they are shuffled at most once.
    """
    joined = (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")) if region else joined


def wide_sales(t: Tables) -> DataFrame:
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(placed_orders(t), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("customer_email"),
            F.col("n_name").alias("customer_address"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("product_price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_price"),
        )
    )


WIDE_SALES_SQL = """wide AS (
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, c_custkey AS customer_id,
         c_name AS customer_name, n_name AS customer_address, p_partkey AS product_id, p_name AS product_name,
         p_type AS product_category, CAST(p_retailprice AS DECIMAL(10,2)) AS product_price,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""


def products(t: Tables) -> DataFrame:
    """Product table before the change batch."""
    return t("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def product_changes(t: Tables) -> DataFrame:
    """Change batch: every product again, some repriced, some recategorised, and new ones."""
    part = t("part")
    repriced, moved = F.col("p_size") >= 40, F.col("p_brand").isin("Brand#3", "Brand#5")
    known = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(moved, "REVISED").otherwise(F.col("p_type")).alias("category"),
        (F.col("p_retailprice") + F.when(repriced, 10.0).otherwise(0.0)).alias("price"),
        F.when(moved, ntz("2024-04-01 09:30:00")).when(repriced, ntz("2024-03-15 11:00:00"))
        .otherwise(ntz("2024-01-01 10:00:00")).alias("updated"),
    )
    shift = part.agg(F.max("p_partkey") + 1).scalar()
    fresh = part.filter("p_type = 'PROMO'").select(
        (F.col("p_partkey") + shift).alias("product_id"),
        F.concat(F.lit("new "), F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        ntz("2024-05-01 14:00:00").alias("updated"),
    )
    return known.unionByName(fresh)


PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price FROM part),
changes AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CASE WHEN p_brand IN ('Brand#3', 'Brand#5') THEN 'REVISED' ELSE p_type END AS category,
         p_retailprice + CASE WHEN p_size >= 40 THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS price,
         CASE WHEN p_brand IN ('Brand#3', 'Brand#5') THEN TIMESTAMP '2024-04-01 09:30:00'
              WHEN p_size >= 40 THEN TIMESTAMP '2024-03-15 11:00:00'
              ELSE TIMESTAMP '2024-01-01 10:00:00' END AS updated
  FROM part
  UNION ALL
  SELECT p_partkey + (SELECT MAX(p_partkey) + 1 FROM part), 'new ' || p_name, p_type, p_retailprice,
         TIMESTAMP '2024-05-01 14:00:00'
  FROM part WHERE p_type = 'PROMO')"""

# The type 2 table after the initial load and the change batch.
VERSIONS_SQL = PRODUCTS_SQL + """,
initial AS (
  SELECT ROW_NUMBER() OVER (ORDER BY product_id) AS dim_key, product_id, product_name, category, price,
         DATE '2024-01-01' AS effective_date FROM products),
staged AS (
  SELECT c.*, CAST(c.updated AS DATE) AS effective, i.dim_key AS existing FROM changes c
  LEFT JOIN initial i ON c.product_id = i.product_id
  WHERE i.dim_key IS NULL OR c.product_name <> i.product_name OR c.category <> i.category OR c.price <> i.price),
versions AS (
  SELECT i.dim_key, i.product_id, i.product_name, i.category, i.price, i.effective_date,
         CASE WHEN s.product_id IS NULL THEN DATE '9999-12-31' ELSE CAST(s.effective - INTERVAL 1 DAY AS DATE) END AS end_date,
         s.product_id IS NULL AS is_current,
         CASE WHEN s.product_id IS NULL THEN '2024-01-02 00:00:00' ELSE '2024-06-01 00:00:00' END AS load_time
  FROM initial i LEFT JOIN staged s ON i.product_id = s.product_id AND i.effective_date < s.effective
  UNION ALL
  SELECT (SELECT MAX(dim_key) FROM initial) + ROW_NUMBER() OVER (ORDER BY product_id), product_id, product_name,
         category, price, effective, DATE '9999-12-31', TRUE, '2024-06-01 00:00:00'
  FROM staged)"""


def subscribers(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    return t("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_acctbal") / 100.0).cast("int").alias("age"),
        F.when(segment == "BUILDING", "Basic").when(segment == "AUTOMOBILE", "Standard")
        .when(segment == "MACHINERY", "Premium").when(segment == "FURNITURE", "Gold").alias("subscription_type"),
    )


SUBSCRIBERS_SQL = """subscribers AS (
  SELECT c_custkey AS customer_id, CAST(FLOOR(c_acctbal / 100.0::DOUBLE) AS INTEGER) AS age,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Basic' WHEN 'AUTOMOBILE' THEN 'Standard'
                           WHEN 'MACHINERY' THEN 'Premium' WHEN 'FURNITURE' THEN 'Gold' END AS subscription_type
  FROM customer)"""


def order_messages(t: Tables) -> DataFrame:
    return t("orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string")).alias("order_id"),
        (F.col("o_totalprice") - 50000.0).alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )


ORDER_MESSAGES_SQL = """messages AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
         o_totalprice - 50000.0::DOUBLE AS amount, CAST(o_orderdate AS DATE) AS order_date FROM orders),
checked AS (
  SELECT *, CASE WHEN order_id IS NULL OR order_id = '' THEN 'order_id'
                 WHEN amount IS NULL OR amount <= 0 THEN 'amount'
                 WHEN order_date IS NULL OR order_date > DATE '2000-01-01' THEN 'order_date' END AS reason
  FROM messages)"""


def outlet_sales(t: Tables) -> DataFrame:
    """Outlet sales: lines with their part and the supplier's place."""
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(F.col("p_size") > 40, None).when(F.col("p_size") > 20, "Medium").otherwise("Small")
            .alias("outlet_size"),
            F.col("r_name").alias("outlet_location_type"),
            F.col("n_name").alias("outlet_type"),
            F.col("p_type").alias("item_type"),
            (F.col("l_extendedprice") / 8).alias("item_outlet_sales"),
        )
    )


OUTLET_SALES_SQL = """outlet_sales AS (
  SELECT CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN 'Medium' ELSE 'Small' END AS outlet_size,
         r_name AS outlet_location_type, n_name AS outlet_type, p_type AS item_type,
         CAST(l_extendedprice / 8 AS DECIMAL(24,6)) AS item_outlet_sales
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def landing_orders(t: Tables) -> DataFrame:
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(placed_orders(t, region=True), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("p_retailprice") / 8).alias("price_per_unit"),
            F.col("o_orderdate").alias("order_date"),
            F.col("r_name").alias("region"),
        )
    )
