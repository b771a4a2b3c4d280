"""Keys, entities, slowly changing dimensions and the layered jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_sum
from tidemark.operators import dimensions as D
from tidemark.operators.joins import as_of, as_of_carried
from tidemark.operators.sets import union_sources
from tidemark.operators.windows import latest_per_key
from tidemark.plans import medallion, warehouse
from tidemark.plans.registry import query
from tidemark.plans.views import (
    CLICKSTREAM_SQL, PRODUCTS_SQL, VERSIONS_SQL, WIDE_SALES_SQL, clickstream, landing_orders, ntz, product_changes,
    products, wide_sales,
)
from tidemark.sources.scratch import new_folder, written
from tidemark.sources.sinks import overwrite_layer, partition_files, put_batch, read_puts

ATTRIBUTES = ["product_name", "category", "price"]
FIRST_LOAD, SECOND_LOAD = "2024-01-02 00:00:00", "2024-06-01 00:00:00"


@query(
    "surrogate_key",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
           100 + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders
    """,
)
def surrogate_key(t):
    orders = t("orders").select("o_orderdate", "o_orderkey")
    keyed = D.surrogate_key(orders, "order_sk", ["o_orderdate", "o_orderkey"], start=101)
    return keyed.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("order_day"), "order_sk")


@query(
    "normalise_entities",
    f"""
    WITH {WIDE_SALES_SQL},
    c AS (SELECT customer_id, ROW_NUMBER() OVER (ORDER BY customer_id) AS sk FROM (SELECT DISTINCT customer_id FROM wide)),
    p AS (SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) AS sk FROM (SELECT DISTINCT product_id FROM wide)),
    o AS (SELECT order_id, ROW_NUMBER() OVER (ORDER BY order_id) AS sk FROM (SELECT DISTINCT order_id FROM wide))
    SELECT 'customer' AS entity, sk, customer_id AS natural_id FROM c UNION ALL SELECT 'product', sk, product_id FROM p
    UNION ALL SELECT 'order', sk, order_id FROM o
    UNION ALL SELECT 'order_item', ROW_NUMBER() OVER (), NULL FROM wide
    """,
)
def normalise_entities(t):
    e = warehouse.normalise(wide_sales(t), unique=True)
    shape = lambda df, name, sk, key: df.select(
        F.lit(name).alias("entity"), F.col(sk).alias("sk"), F.col(key).alias("natural_id")
    )
    return union_sources(
        [
            shape(e.customers, "customer", "customer_sk", "customer_id"),
            shape(e.products, "product", "product_sk", "product_id"),
            shape(e.orders, "order", "order_sk", "order_id"),
            shape(e.order_items.withColumn("none", F.lit(None).cast("bigint")), "order_item", "order_item_sk", "none"),
        ]
    )


@query(
    "star_fact",
    f"""
    WITH {WIDE_SALES_SQL},
    c AS (SELECT customer_id, ROW_NUMBER() OVER (ORDER BY customer_id) AS sk FROM (SELECT DISTINCT customer_id FROM wide)),
    p AS (SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) AS sk FROM (SELECT DISTINCT product_id FROM wide)),
    o AS (SELECT order_id, ROW_NUMBER() OVER (ORDER BY order_id) AS sk FROM (SELECT DISTINCT order_id FROM wide))
    SELECT o.sk AS order_sk, c.sk AS customer_key, p.sk AS product_key,
           CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, quantity,
           CAST(product_price AS DOUBLE) AS unit_price, CAST(quantity * product_price AS DOUBLE) AS total_sales_amount
    FROM wide JOIN c USING (customer_id) JOIN p USING (product_id) JOIN o USING (order_id)
    """,
)
def star_fact(t):
    """Fact rows whose unit price comes from the product dimension."""
    fact = warehouse.sales_fact(warehouse.normalise(wide_sales(t), number_items=False, unique=True))
    return fact.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "total_sales_amount")})


@query(
    "dim_date",
    """
    SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date,
           strftime(o_orderdate, '%a') AS day_of_week, strftime(o_orderdate, '%b') AS month_name,
           CAST(QUARTER(o_orderdate) AS INTEGER) AS quarter, CAST(YEAR(o_orderdate) AS INTEGER) AS year FROM orders
    """,
)
def dim_date(t):
    return D.date_dimension(t("orders"), "o_orderdate").withColumn("full_date", F.col("full_date").cast("string"))


def _time_text(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


def _loaded(t):
    return products(t).withColumn("load_time", ntz(FIRST_LOAD))


_MERGED_SQL = f"""WITH {PRODUCTS_SQL}, j AS (
  SELECT p.product_id IS NULL AS fresh, c.product_id IS NOT NULL AND (p.product_id IS NULL OR p.product_name <> c.product_name
         OR p.category <> c.category OR p.price <> c.price) AS touched,
         COALESCE(p.product_id, c.product_id) AS product_id, p.product_name AS old_name, p.category AS old_category,
         p.price AS old_price, c.product_name AS new_name, c.category AS new_category, c.price AS new_price
  FROM products p FULL JOIN changes c ON p.product_id = c.product_id)"""


@query(
    "scd1_merge",
    f"""
    {_MERGED_SQL}
    SELECT product_id, CASE WHEN touched THEN new_name ELSE old_name END AS product_name,
           CASE WHEN touched THEN new_category ELSE old_category END AS category,
           CASE WHEN touched THEN new_price ELSE old_price END AS price,
           CASE WHEN touched THEN '{SECOND_LOAD}' ELSE '{FIRST_LOAD}' END AS load_time FROM j
    """,
)
def scd1_merge(t):
    merged = D.scd1_merge(_loaded(t), product_changes(t), "product_id", ATTRIBUTES, "load_time", ntz(SECOND_LOAD))
    return _time_text(merged, "load_time")


@query(
    "scd0",
    f"""
    WITH {PRODUCTS_SQL}
    SELECT * FROM products UNION ALL SELECT product_id, product_name, category, price FROM changes
    WHERE product_id NOT IN (SELECT product_id FROM products)
    """,
)
def scd0(t):
    return D.scd0_insert(products(t), product_changes(t), "product_id")


@query(
    "scd3",
    f"""
    {_MERGED_SQL}
    SELECT product_id, COALESCE(new_name, old_name) AS product_name, COALESCE(new_category, old_category) AS category,
           COALESCE(new_price, old_price) AS price, CASE WHEN old_price <> new_price THEN old_price END AS previous_price FROM j
    """,
)
def scd3(t):
    return D.scd3_merge(products(t), product_changes(t).drop("updated"), "product_id", "price")


@query(
    "scd4_history",
    f"""
    {_MERGED_SQL}
    SELECT product_id, old_name AS product_name, old_category AS category, old_price AS price, '{FIRST_LOAD}' AS load_time,
           '{SECOND_LOAD}' AS replaced_at FROM j WHERE touched AND NOT fresh
    """,
)
def scd4_history(t):
    _, replaced = D.scd4_split(
        _loaded(t), product_changes(t), "product_id", ATTRIBUTES, "load_time", ntz(SECOND_LOAD)
    )
    return _time_text(replaced, "load_time", "replaced_at")


def _versions(t):
    first = products(t).withColumn("updated", ntz("2024-01-01 10:00:00"))
    dim = D.new_dimension(first, "dim_key", "product_id", ATTRIBUTES, "updated", ntz(FIRST_LOAD))
    return D.scd2_apply(
        dim, product_changes(t), "dim_key", "product_id", ATTRIBUTES, "updated", ntz(SECOND_LOAD)
    )


def _version_text(df):
    dated = df.withColumns({c: F.col(c).cast("string") for c in ("effective_date", "end_date")})
    return _time_text(dated, "load_time")


_VERSION_COLUMNS = """dim_key, product_id, product_name, category, price, CAST(effective_date AS VARCHAR) AS effective_date,
       CAST(end_date AS VARCHAR) AS end_date, is_current, load_time"""


@query("scd2_apply", f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions")
def scd2_apply(t):
    return _version_text(_versions(t))


@query("scd2_two_rows", f"WITH {VERSIONS_SQL} SELECT {_VERSION_COLUMNS} FROM versions")
def scd2_two_rows(t):
    """The type 2 load as one closing and one opening row per change."""
    first = products(t).withColumn("updated", ntz("2024-01-01 10:00:00"))
    dim = D.new_dimension(first, "dim_key", "product_id", ATTRIBUTES, "updated", ntz(FIRST_LOAD))
    return _version_text(D.scd2_two_rows(dim, product_changes(t), "dim_key", "product_id", ATTRIBUTES, "updated", ntz(SECOND_LOAD)))


@query(
    "scd2_late_rows",
    f"""
    WITH {PRODUCTS_SQL}
    SELECT c.product_id, c.product_name, c.category, c.price FROM changes c JOIN products p ON c.product_id = p.product_id
    WHERE p.product_name <> c.product_name OR p.category <> c.category OR p.price <> c.price
    """,
)
def scd2_late_rows(t):
    """Changes of the day their version opened: a strict load leaves them out, and they are listed here."""
    first = products(t).withColumn("updated", ntz("2024-01-01 10:00:00"))
    dim = D.new_dimension(first, "dim_key", "product_id", ATTRIBUTES, "updated", ntz(FIRST_LOAD))
    same_day = product_changes(t).withColumn("updated", ntz("2024-01-01 23:00:00"))
    return D.late_rows(dim, same_day, "dim_key", "product_id", ATTRIBUTES, "updated").select("product_id", *ATTRIBUTES)


@query(
    "scd6",
    f"""
    WITH {VERSIONS_SQL}
    SELECT v.dim_key, v.product_id, v.category, v.price, v.is_current, c.category AS current_category, c.price AS current_price
    FROM versions v LEFT JOIN versions c ON v.product_id = c.product_id AND c.is_current
    """,
)
def scd6(t):
    view = D.scd6_view(_versions(t), "product_id", ["category", "price"])
    return view.select("dim_key", "product_id", "category", "price", "is_current", "current_category", "current_price")


@query(
    "scd2_asof_join",
    f"""
    WITH {VERSIONS_SQL},
    facts AS (SELECT l_partkey AS part_id, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) + 9300 AS sold_on FROM lineitem)
    SELECT category, is_current, COUNT(*) AS "lines", CAST(SUM(CAST(l_extendedprice AS DECIMAL(24,6))) AS DOUBLE) AS sales
    FROM facts LEFT JOIN versions ON part_id = product_id AND sold_on BETWEEN effective_date AND end_date
    GROUP BY category, is_current
    """,
)
def scd2_asof_join(t):
    """Line dates are shifted into the years of the product versions."""
    facts = t("lineitem").select(
        F.col("l_partkey").alias("part_id"), "l_extendedprice", F.date_add(F.to_date("l_shipdate"), 9300).alias("sold_on")
    )
    joined = as_of(facts, _versions(t).withColumnRenamed("product_id", "part_id"), "part_id", "sold_on")
    return joined.groupBy("category", "is_current").agg(
        F.count("*").alias("lines"), exact_sum("l_extendedprice").alias("sales")
    )


@query(
    "asof_carried",
    f"""
    WITH {VERSIONS_SQL},
    facts AS (SELECT l_orderkey, l_linenumber, l_partkey AS part_id, CAST(l_shipdate AS DATE) + 9300 AS sold_on FROM lineitem)
    SELECT f.*, dim_key, category, effective_date, end_date
    FROM facts f LEFT JOIN versions ON part_id = product_id AND sold_on BETWEEN effective_date AND end_date
    """,
)
def asof_carried(t):
    """Each line with the product version in force, carried forward by date instead of joined by range."""
    facts = t("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_id"), F.date_add(F.to_date("l_shipdate"), 9300).alias("sold_on")
    )
    versions = _versions(t).select(F.col("product_id").alias("part_id"), "dim_key", "category", "effective_date", "end_date")
    return as_of_carried(facts, versions, "part_id", "sold_on", ["l_orderkey", "l_linenumber"])


@query(
    "keyed_upsert",
    """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def keyed_upsert(t):
    """Two batches of puts by user, then the table they leave."""
    path = new_folder(t.spark, "puts")
    events = t("events").select("user_id", "event_id", "event_type", "value", "ts")
    cut = ntz("2024-01-20 00:00:00")
    for batch_id, rows in enumerate([events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)]):
        last = latest_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])
        put_batch(last.drop("ts"), path, batch_id)
    return read_puts(t.spark, path, "user_id bigint, event_id bigint, event_type string, value double", ["user_id"])


@query(
    "bronze_to_monthly",
    """
    SELECT CAST(l_partkey AS VARCHAR) AS product_id, r_name AS region, strftime(o_orderdate, '%Y-%m') AS month,
           CAST(SUM(CAST(CAST(l_quantity AS INTEGER) * (p_retailprice / 8) AS DECIMAL(24,6))) AS DOUBLE) AS total_sales,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
    """,
)
def bronze_to_monthly(t):
    """The bronze and the monthly layer are written, and the monthly one read back."""
    path = new_folder(t.spark, "monthly")
    bronze = overwrite_layer(warehouse.bronze_orders(landing_orders(t), ntz(SECOND_LOAD)), f"{path}/bronze")
    return overwrite_layer(warehouse.monthly_sales(bronze), f"{path}/monthly")


@query(
    "monthly_partitions",
    """
    SELECT product_id, region, month, CASE WHEN month < '1996-01' THEN 2 * n ELSE n END AS total_quantity, month >= '1996-01' AS rewritten
    FROM (SELECT CAST(l_partkey AS VARCHAR) AS product_id, r_name AS region, strftime(o_orderdate, '%Y-%m') AS month,
                 CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          GROUP BY ALL)
    """,
)
def monthly_partitions(t):
    """All months loaded with doubled quantities, then those from 1996 on again as they are; files of the others stay."""
    path = new_folder(t.spark, "months")
    bronze, monthly = f"{path}/bronze", f"{path}/monthly"
    landing = landing_orders(t)
    warehouse.load_months(landing.withColumn("quantity", F.col("quantity") * 2), ntz(FIRST_LOAD), bronze, monthly)
    before = written(partition_files(t.spark, monthly, "month"), "files")
    warehouse.load_months(landing.filter(F.col("order_date") >= "1996-01-01"), ntz(SECOND_LOAD), bronze, monthly)
    after = partition_files(t.spark, monthly, "month")
    kept = after.join(before, ["month", "file", "modified"], "left_semi").select(F.col("month").alias("_month")).distinct()
    rows = t.spark.read.schema("product_id string, region string, total_sales double, total_quantity bigint, month string").parquet(monthly)
    marked = rows.join(kept, F.col("month") == F.col("_month"), "left")
    return marked.select("product_id", "region", "month", "total_quantity", F.col("_month").isNull().alias("rewritten"))


@query(
    "medallion_gold",
    f"""
    WITH {CLICKSTREAM_SQL},
    s AS (SELECT *, CAST(price * unit AS DECIMAL(24,6)) AS sales FROM clickstream
          WHERE device IS NOT NULL AND unit IS NOT NULL AND price IS NOT NULL AND event_name IS NOT NULL AND traffic_source IS NOT NULL)
    SELECT 'sales_by_device' AS kpi, device, NULL AS traffic_source, CAST(SUM(sales) AS DOUBLE) AS value FROM s GROUP BY device
    UNION ALL SELECT 'sales_by_traffic', NULL, traffic_source, CAST(SUM(sales) AS DOUBLE) FROM s GROUP BY traffic_source
    UNION ALL SELECT 'orders', device, traffic_source, CAST(COUNT(*) AS DOUBLE) FROM s WHERE event_name = 'purchase' GROUP BY ALL
    UNION ALL SELECT 'conversion', device, NULL, COUNT(CASE WHEN event_name = 'purchase' THEN 1 END)
              / CAST(NULLIF(COUNT(CASE WHEN event_name = 'click' THEN 1 END), 0) AS DOUBLE) FROM s GROUP BY device
    """,
)
def medallion_gold(t):
    """Bronze, silver and the pre-aggregate are written once each; the four KPIs roll up from the last."""
    kpis = medallion.run(clickstream(t), new_folder(t.spark, "medallion"), order_event="purchase", cart_event="click")
    return medallion.gold_rows(kpis)
