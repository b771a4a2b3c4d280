"""Aggregate and window queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import compact_number, percent_text
from tidemark.functions.numbers import exact_avg, exact_sum, exact_total, net_price
from tidemark.functions.times import month_key
from tidemark.operators import aggregates as A
from tidemark.operators import windows as W
from tidemark.operators.ordering import sequence_block
from tidemark.operators.sets import union_sources
from tidemark.operators.topk import top_rows
from tidemark.plans import outlet_sales as outlets
from tidemark.plans.registry import query
from tidemark.plans.views import (
    CLICKSTREAM_SQL, NET_SQL, OUTLET_SALES_SQL, clickstream, ntz, outlet_sales, placed_orders,
)


def money_sql(name: str) -> str:
    return f"CAST(SUM(CAST({name} AS DECIMAL(24,6))) AS DOUBLE)"


def _sales_events(t):
    rows = clickstream(t).select("event_id", "device", "ecommerce.unit", "ecommerce.price", "event_name", "traffic_source")
    return rows.withColumn("sales", F.col("price") * F.col("unit"))


def _sales():
    return exact_sum("sales")


_SALES_SQL = "CAST(price * unit AS DECIMAL(24,6))"


@query(
    "sales_by_key",
    f"WITH {CLICKSTREAM_SQL} SELECT device, CAST(SUM({_SALES_SQL}) AS DOUBLE) AS total_sales FROM clickstream GROUP BY device",
)
def sales_by_key(t):
    return A.grouped(_sales_events(t), ["device"], {"total_sales": _sales()}, ["total_sales"])


@query(
    "revenue_stats",
    f"""
    WITH {CLICKSTREAM_SQL}
    SELECT device, CAST(SUM({_SALES_SQL}) AS DOUBLE) AS sum_rev,
           CAST(SUM({_SALES_SQL}) AS DOUBLE) / CAST(COUNT({_SALES_SQL}) AS DOUBLE) AS avg_rev FROM clickstream GROUP BY device
    """,
)
def revenue_stats(t):
    average = exact_avg("sales")
    measures = {"sum_rev": _sales(), "avg_rev": average}
    return A.grouped(_sales_events(t), ["device"], measures)


_BY_AGGS = [("l_extendedprice", "sum"), ("l_quantity", "max"), ("l_partkey", "count_distinct"), ("l_orderkey", "count")]
_BY_SQL = """CAST(SUM(CAST(l_extendedprice AS DECIMAL(24,6))) AS DOUBLE) AS total_price, MAX(l_quantity) AS max_quantity,
       COUNT(DISTINCT l_partkey) AS parts, COUNT(l_orderkey) AS "lines" FROM lineitem"""


def _aggregated(t, groups):
    rows = t("lineitem").withColumn("l_extendedprice", F.col("l_extendedprice").try_cast("decimal(24,6)"))
    return A.aggregate(rows, groups, _BY_AGGS).select(
        *groups,
        F.col("`sum(l_extendedprice)`").cast("double").alias("total_price"),
        F.col("`max(l_quantity)`").alias("max_quantity"),
        F.col("`count_distinct(l_partkey)`").alias("parts"),
        F.col("`count(l_orderkey)`").alias("lines"),
    )


@query("aggregate_by", f"SELECT l_returnflag, l_linestatus, {_BY_SQL} GROUP BY l_returnflag, l_linestatus")
def aggregate_by(t):
    return _aggregated(t, ["l_returnflag", "l_linestatus"])


@query("aggregate_global", f"SELECT {_BY_SQL}")
def aggregate_global(t):
    return _aggregated(t, [])


_KPI_ROW = "CAST(SUM(item_outlet_sales) AS DOUBLE) AS total_sales, COUNT(item_type) AS items_sold FROM outlet_sales GROUP BY ALL"


@query(
    "kpi_three_way",
    f"""
    WITH {OUTLET_SALES_SQL}
    SELECT 'location_outlet' AS kpi, outlet_location_type AS key1, outlet_size AS key2, NULL AS key3, {_KPI_ROW}
    UNION ALL SELECT 'sales_item_type', item_type, NULL, NULL, {_KPI_ROW}
    UNION ALL SELECT 'outlet_location_item', outlet_type, outlet_location_type, item_type, {_KPI_ROW}
    """,
)
def kpi_three_way(t):
    """The three KPIs from one pre-aggregate of the selection."""
    results = outlets.kpis(outlet_sales(t).select(*outlets.SELECTION))
    parts = []
    for name, (groups, total, sold) in outlets.KPIS.items():
        keys = [F.col(g).alias(f"key{i}") for i, g in enumerate(groups, 1)]
        keys += [F.lit(None).cast("string").alias(f"key{i}") for i in range(len(groups) + 1, 4)]
        parts.append(
            results[name].select(
                F.lit(name).alias("kpi"), *keys, F.col(total).alias("total_sales"), F.col(sold).alias("items_sold")
            )
        )
    return union_sources(parts)


@query(
    "orders_by_group",
    f"""
    WITH {CLICKSTREAM_SQL}
    SELECT device, traffic_source, COUNT(*) AS total_orders FROM clickstream WHERE event_name = 'purchase' GROUP BY ALL
    """,
)
def orders_by_group(t):
    placed = clickstream(t).filter("event_name = 'purchase'")
    return A.grouped(placed, ["device", "traffic_source"], {"total_orders": F.count("*")}, ["total_orders"])


@query(
    "conversion_rate",
    f"""
    WITH {CLICKSTREAM_SQL}
    SELECT device, traffic_source, unit, COUNT(CASE WHEN event_name = 'purchase' THEN 1 END) AS orders,
           COUNT(CASE WHEN event_name = 'click' THEN 1 END) AS carts,
           COUNT(CASE WHEN event_name = 'purchase' THEN 1 END)
             / CAST(NULLIF(COUNT(CASE WHEN event_name = 'click' THEN 1 END), 0) AS DOUBLE) AS conversion_rate
    FROM clickstream GROUP BY ALL
    """,
)
def conversion_rate(t):
    rows = clickstream(t).select("device", "traffic_source", "ecommerce.unit", "event_name")
    event = F.col("event_name")
    return A.conversion(rows, ["device", "traffic_source", "unit"], event == "purchase", event == "click")


@query(
    "avg_amount_by_group",
    f"""
    SELECT n_name AS country, p_type AS category, {money_sql('l_extendedprice')} / CAST(COUNT(l_extendedprice) AS DOUBLE) AS avg_amount
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
    WHERE l_extendedprice > 5000 GROUP BY ALL
    """,
)
def avg_amount_by_group(t):
    """Lines are summed per part and country before the parts join."""
    sold = t("lineitem").filter(F.col("l_extendedprice") > 5000).join(placed_orders(t), F.col("l_orderkey") == F.col("o_orderkey"))
    per_part = sold.groupBy("l_partkey", "n_name").agg(exact_total("l_extendedprice").alias("_sum"), F.count("l_extendedprice").alias("_n"))
    joined = per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(F.col("n_name").alias("country"), F.col("p_type").alias("category")).agg(
        F.try_divide(F.sum("_sum").cast("double"), F.sum("_n").cast("double")).alias("avg_amount")
    )


@query(
    "monthly_rollup",
    f"""
    SELECT l_partkey AS product_id, r_name AS region, strftime(o_orderdate, '%Y-%m') AS month,
           {money_sql('l_extendedprice')} AS total_sales, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
    """,
)
def monthly_rollup(t):
    joined = t("lineitem").join(placed_orders(t, region=True), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(
        F.col("l_partkey").alias("product_id"), F.col("r_name").alias("region"), month_key("o_orderdate").alias("month")
    ).agg(
        exact_sum("l_extendedprice").alias("total_sales"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
    )


@query(
    "multi_product_customers",
    """
    SELECT c_name, COUNT(DISTINCT l_partkey) AS unique_products FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_name HAVING COUNT(DISTINCT l_partkey) > 1
    """,
)
def multi_product_customers(t):
    buyers = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = t("lineitem").join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    counted = joined.groupBy("c_name").agg(F.count_distinct("l_partkey").alias("unique_products"))
    return counted.filter("unique_products > 1").orderBy(F.desc("unique_products"), "c_name")


@query("distinct_entities", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_entities(t):
    return t("customer").select("c_nationkey", "c_mktsegment").distinct()


@query(
    "sales_by_category",
    f"""
    SELECT p_type AS product_category, CAST(SUM({NET_SQL}) AS DOUBLE) AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
    """,
)
def sales_by_category(t):
    """Lines are summed per part first; the join then sees one row per part."""
    per_part = t("lineitem").groupBy("l_partkey").agg(exact_total(net_price()).alias("s"))
    joined = per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.grouped(
        joined, ["p_type"], {"total_sales": F.sum("s").cast("double")}, [F.desc("total_sales")]
    ).withColumnRenamed("p_type", "product_category")


@query(
    "sales_by_customer",
    f"""
    SELECT c_name, {money_sql('o_totalprice')} AS total_sales FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name
    """,
)
def sales_by_customer(t):
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.grouped(joined, ["c_name"], {"total_sales": exact_sum("o_totalprice")}, [F.desc("total_sales")])


@query(
    "daily_sales",
    f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, {money_sql('o_totalprice')} AS daily_sales
    FROM orders GROUP BY ALL
    """,
)
def daily_sales(t):
    days = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(exact_sum("o_totalprice").alias("daily_sales"))
    return days.orderBy("day").select(F.col("day").cast("string").alias("full_date"), "daily_sales")


@query("count_by_category", "SELECT c_mktsegment AS subscription_type, COUNT(*) AS customers FROM customer GROUP BY ALL")
def count_by_category(t):
    return t("customer").groupBy(F.col("c_mktsegment").alias("subscription_type")).agg(F.count("*").alias("customers"))


@query(
    "revenue_by_region",
    f"""
    SELECT r_name AS region_name, {money_sql('o_totalprice')} AS revenue, COUNT(*) AS orders
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey
    JOIN orders ON c_custkey = o_custkey
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'
    GROUP BY r_name ORDER BY revenue DESC
    """,
)
def revenue_by_region(t):
    """Revenue by region for one quarter and one status, best first."""
    placed = F.col("o_orderdate")
    quarter = (placed >= ntz("1997-01-01 00:00:00")) & (placed < ntz("1997-04-01 00:00:00"))
    joined = (
        t("orders").filter((F.col("o_orderstatus") == "F") & quarter)
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        joined.groupBy(F.col("r_name").alias("region_name"))
        .agg(exact_sum("o_totalprice").alias("revenue"), F.count("*").alias("orders"))
        .orderBy(F.desc("revenue"))
    )


@query(
    "best_sellers",
    """
    SELECT p_name, p_brand, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name, p_brand
    """,
)
def best_sellers(t):
    per_part = t("lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    joined = per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.grouped(joined, ["p_name", "p_brand"], {"quantity": F.sum("q")}, [F.desc("quantity")])


@query(
    "orders_per_channel",
    "SELECT o_orderpriority AS channel, COUNT(*) AS orders FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY ALL",
)
def orders_per_channel(t):
    recent = t("orders").filter(F.col("o_orderdate") >= ntz("1999-01-01 00:00:00"))
    return recent.groupBy(F.col("o_orderpriority").alias("channel")).agg(F.count("*").alias("orders")).orderBy(F.desc("orders"))


@query(
    "avg_order_by_segment",
    f"""
    SELECT c_mktsegment AS segment, {money_sql('o_totalprice')} / CAST(COUNT(o_totalprice) AS DOUBLE) AS avg_order_value, COUNT(*) AS orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL
    """,
)
def avg_order_by_segment(t):
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        exact_avg("o_totalprice").alias("avg_order_value"), F.count("*").alias("orders")
    )


@query("row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def row_count(t):
    return t("lineitem").agg(F.count("*").alias("row_count"))


@query(
    "min_max",
    """
    SELECT o_orderstatus, MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price,
           CAST(CAST(MIN(o_orderdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) AS last_day
    FROM orders GROUP BY ALL
    """,
)
def min_max(t):
    as_day = lambda c: F.to_date(c).cast("string")
    return t("orders").groupBy("o_orderstatus").agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        as_day(F.min("o_orderdate")).alias("first_day"), as_day(F.max("o_orderdate")).alias("last_day"),
    )


@query(
    "active_users",
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(DISTINCT user_id) AS active_users
    FROM events WHERE event_type IS NOT NULL GROUP BY ALL
    """,
)
def active_users(t):
    seen = t("events").filter("event_type IS NOT NULL").groupBy(F.to_date("ts").alias("day"))
    counted = seen.agg(F.count_distinct("user_id").alias("active_users"))
    return counted.select(F.col("day").cast("string").alias("day"), "active_users")


@query(
    "share_of_total",
    f"""
    WITH b AS (SELECT p_brand, SUM(CAST(l_extendedprice AS DECIMAL(24,6))) AS s
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT p_brand, CAST(s AS DOUBLE) AS sales, CAST(s AS DOUBLE) / CAST(SUM(s) OVER () AS DOUBLE) AS share FROM b
    """,
)
def share_of_total(t):
    per_part = t("lineitem").groupBy("l_partkey").agg(exact_total("l_extendedprice").alias("s"))
    joined = per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    brands = joined.groupBy("p_brand").agg(F.sum("s").alias("exact"))
    total = brands.agg(F.sum("exact").cast("double")).scalar()
    sales = F.col("exact").cast("double")
    return brands.select("p_brand", sales.alias("sales"), F.try_divide(sales, total).alias("share"))


@query(
    "executive_numbers",
    f"""
    WITH s AS (SELECT o_orderpriority, o_orderstatus, {money_sql('o_totalprice')} AS v, COUNT(*) AS n FROM orders GROUP BY ALL)
    SELECT o_orderpriority, o_orderstatus,
           CASE WHEN v >= 1e9 THEN '$' || regexp_replace(printf('%.1f', v / 1e9), '\\.0$', '') || 'B'
                WHEN v >= 1e6 THEN '$' || regexp_replace(printf('%.1f', v / 1e6), '\\.0$', '') || 'M'
                WHEN v >= 1e3 THEN '$' || regexp_replace(printf('%.1f', v / 1e3), '\\.0$', '') || 'K'
                ELSE '$' || regexp_replace(printf('%.1f', v), '\\.0$', '') END AS sales,
           printf('%.1f%%', n * 100.0::DOUBLE / (SELECT SUM(n) FROM s)) AS share
    FROM s
    """,
)
def executive_numbers(t):
    groups = t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        exact_sum("o_totalprice").alias("v"), F.count("*").alias("n")
    )
    shared = A.with_share(groups, "n")
    return shared.select(
        "o_orderpriority", "o_orderstatus",
        compact_number("v", "$").alias("sales"), percent_text("share").alias("share"),
    )


@query(
    "top_per_group",
    f"""
    SELECT outlet_location_type, tier, item_type, total_sales FROM (
      SELECT *, RANK() OVER (PARTITION BY outlet_location_type, tier ORDER BY total_sales DESC) AS r FROM (
        SELECT r_name AS outlet_location_type, n_name AS tier, p_type AS item_type, {money_sql('l_extendedprice / 8')} AS total_sales
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL))
    WHERE r = 1
    """,
)
def top_per_group(t):
    sales = outlet_sales(t).groupBy(
        "outlet_location_type", F.col("outlet_type").alias("tier"), "item_type"
    ).agg(exact_sum("item_outlet_sales").alias("total_sales"))
    best = W.top_per_group(sales, ["outlet_location_type", "tier"], [F.asc("tier"), F.desc("total_sales")])
    return best.orderBy("outlet_location_type", "tier")


@query(
    "qualify_rank",
    """
    SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
    QUALIFY DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) <= 3
    """,
)
def qualify_rank(t):
    rank = F.dense_rank().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice")))
    return W.qualify(t("orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), rank, 3)


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, o_totalprice FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def latest_per_key(t):
    last = W.latest_per_key(t("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return last.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("string").alias("order_day"), "o_totalprice")


@query(
    "version_number",
    """
    SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version
    FROM orders
    """,
)
def version_number(t):
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    levels = [("_day", F.to_date("o_orderdate")), ("_block", sequence_block("o_orderkey"))]
    numbered = W.version_number(orders, ["o_custkey"], levels, ["o_orderdate", "o_orderkey"])
    return numbered.select("o_custkey", "o_orderkey", "version")


@query(
    "period_growth",
    f"""
    WITH m AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month, {money_sql('o_totalprice')} AS sales
               FROM orders GROUP BY ALL),
    p AS (SELECT *, LAG(sales) OVER (PARTITION BY o_orderpriority ORDER BY month) AS previous FROM m)
    SELECT *, (sales - previous) * 100.0::DOUBLE / NULLIF(previous, 0) AS growth_pct FROM p
    """,
)
def period_growth(t):
    months = t("orders").groupBy("o_orderpriority", month_key("o_orderdate").alias("month")).agg(
        exact_sum("o_totalprice").alias("sales")
    )
    return W.period_growth(months, ["o_orderpriority"], "month", "sales")


@query(
    "magnitude_outliers",
    """
    WITH m AS (SELECT MEDIAN(value) AS median FROM events)
    SELECT event_id, value, ROUND(median, 4) AS median, CASE WHEN ABS(value) > ABS(median) THEN 'above' ELSE 'below' END AS direction
    FROM events, m WHERE ABS(value) >= ABS(median) * 10 OR ABS(value) * 10 <= ABS(median)
    """,
)
def magnitude_outliers(t):
    far = W.magnitude_outliers(t("events").select("event_id", "value"), "value")
    return far.withColumn("median", F.round("median", 4))


@query(
    "recent_events",
    "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 10",
)
def recent_events(t):
    return top_rows(t("events"), [F.desc("ts"), "event_id"], 10).select("event_id", "user_id", "event_type")
