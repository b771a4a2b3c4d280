"""Scans, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.device_events import enriched
from tidemark.functions.numbers import exact_sum, net_price
from tidemark.functions.times import GRAINS, date_key, grain_start, within
from tidemark.operators.sets import union_sources
from tidemark.plans.registry import query
from tidemark.plans.views import (
    CLICKSTREAM_SQL, DEVICE_EVENTS_SQL, PRODUCTS_SQL, clickstream, day, device_events, product_changes,
    products, prop_k,
)
from tidemark.sources.scratch import new_folder
from tidemark.sources.sinks import append_by_date


@query("scan_parquet", "SELECT * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate) FROM lineitem")
def scan_parquet(t):
    return t("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


@query(
    "partitioned_roundtrip",
    """
    SELECT CAST(YEAR(ts) AS INTEGER) AS year, CAST(MONTH(ts) AS INTEGER) AS month, CAST(DAY(ts) AS INTEGER) AS day,
           event_id, value FROM events
    """,
)
def partitioned_roundtrip(t):
    """Date-partitioned append, then the scan of what was written."""
    path = new_folder(t.spark, "events-by-date")
    events = t("events").select("event_id", "value", F.col("ts").alias("created_at"))
    append_by_date(C.with_date_parts(events).drop("created_at"), path)
    schema = "event_id bigint, value double, year int, month int, day int"
    return t.spark.read.schema(schema).parquet(path).select("year", "month", "day", "event_id", "value")


@query("select_columns", "SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def select_columns(t):
    return t("part").select("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("json_extract", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def json_extract(t):
    return t("events").select("event_id", prop_k().alias("k"))


@query("line_revenue", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1.0::DOUBLE - l_discount) AS revenue FROM lineitem")
def line_revenue(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", net_price().alias("revenue"))


@query(
    "apply_mapping",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS total_amount,
           TRY_CAST(SUBSTRING(o_orderpriority, 1, 1) AS BIGINT) AS channel_number,
           TRY_CAST(o_orderstatus AS BIGINT) AS status_number FROM orders
    """,
)
def apply_mapping(t):
    rows = t("orders").withColumn("left(o_orderpriority, 1)", F.substring("o_orderpriority", 1, 1))
    return C.apply_mapping(
        rows,
        [
            ("o_orderkey", "long", "order_id", "string"),
            ("o_totalprice", "double", "total_amount", "double"),
            ("`left(o_orderpriority, 1)`", "string", "channel_number", "long"),
            ("o_orderstatus", "string", "status_number", "long"),
        ],
    )


@query(
    "not_null_filter",
    """
    SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
    WHERE lang IS NOT NULL AND source IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL AND n_chars IS NOT NULL
    """,
)
def not_null_filter(t):
    rows = t("documents").select("doc_id", "lang", "source", "n_chars").join(t("labels"), "doc_id", "left")
    return rows.dropna(subset=["lang", "source", "quality", "toxic", "n_chars"]).drop("n_chars")


@query(
    "predicates",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_totalprice > 50000 AND o_totalprice <= 450000 AND o_orderstatus <> 'P'
           AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
           AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_custkey IS NOT NULL)
       OR (o_orderpriority LIKE '%SPEC%' AND o_totalprice < 2000) OR o_totalprice IS NULL
    """,
)
def predicates(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    first, last = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1999-12-31").cast("timestamp_ntz")
    main = (
        (price > 50000) & (price <= 450000) & (F.col("o_orderstatus") != "P")
        & F.col("o_orderdate").between(first, last)
        & priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM") & F.col("o_custkey").isNotNull()
    )
    other = (priority.like("%SPEC%") & (price < 2000)) | price.isNull()
    return t("orders").filter(main | other).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "change_classify",
    f"""
    WITH {PRODUCTS_SQL}
    SELECT c.product_id,
           CASE WHEN p.product_id IS NULL THEN 'INSERT_NEW'
                WHEN c.product_name <> p.product_name OR c.category <> p.category OR c.price <> p.price
                THEN 'UPDATE_EXISTING' ELSE 'NO_CHANGE' END AS action_type
    FROM changes c LEFT JOIN products p ON c.product_id = p.product_id
    """,
)
def change_classify(t):
    names = ["product_name", "category", "price"]
    joined = product_changes(t).alias("c").join(
        products(t).alias("p"), F.col("c.product_id") == F.col("p.product_id"), "left"
    )
    changed = C.any_difference([F.col(f"p.{n}") for n in names], [F.col(f"c.{n}") for n in names])
    return joined.select(
        "c.product_id", C.change_action(F.col("p.product_id").isNull(), changed).alias("action_type")
    )


_ENRICHED_SQL = f"""{DEVICE_EVENTS_SQL}, enriched AS (
  SELECT *, CASE status WHEN 'active' THEN 'Operational' WHEN 'inactive' THEN 'Standby'
                        WHEN 'faulty' THEN 'Requires Maintenance' ELSE 'Unknown' END AS status_transformed,
         CASE event_type WHEN 'sensor_reading' THEN 'E101' WHEN 'alert' THEN 'E202'
                         WHEN 'heartbeat' THEN 'E303' ELSE 'E000' END AS event_type_transformed
  FROM device_events)"""


@query("event_code_map", f"WITH {_ENRICHED_SQL} SELECT event_id, status_transformed, event_type_transformed FROM enriched")
def event_code_map(t):
    return device_events(t).select(
        "event_id",
        C.mapped("status", C.STATUS_CATEGORY, C.STATUS_DEFAULT).alias("status_transformed"),
        C.mapped("event_type", C.EVENT_CODE, C.EVENT_CODE_DEFAULT).alias("event_type_transformed"),
    )


_PRIORITY_SQL = """CASE WHEN status_transformed = 'Requires Maintenance' OR event_type_transformed = 'E202'
                        THEN 'High' ELSE 'Normal' END"""


@query("event_priority", f"WITH {_ENRICHED_SQL} SELECT event_id, {_PRIORITY_SQL} AS priority_level FROM enriched")
def event_priority(t):
    return enriched(device_events(t)).select("event_id", "priority_level")


@query(
    "event_enrich",
    f"""
    WITH {_ENRICHED_SQL}
    SELECT event_id, status, event_type, status_transformed, event_type_transformed, latitude, longitude,
           CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL ELSE '' END || CASE WHEN latitude > 0 THEN 'Northern Hemisphere' ELSE 'Southern Hemisphere' END || ', ' ||
           CASE WHEN longitude > 0 THEN 'Eastern' ELSE 'Western' END AS region,
           CAST(ROUND(latitude, 2) AS VARCHAR) || '|' || CAST(ROUND(longitude, 2) AS VARCHAR) AS geohash,
           {_PRIORITY_SQL} AS priority_level
    FROM enriched
    """,
)
def event_enrich(t):
    """Batch form of the enrichment stream."""
    return enriched(device_events(t)).select(
        "event_id", "status", "event_type", "status_transformed", "event_type_transformed",
        "location_transformed.*", "priority_level",
    )


TODAY = "1998-05-15"
# Named ranges and, for that day, their inclusive bounds.
RANGES = {
    "last month": ("1998-04-01", "1998-04-30"),
    "ytd": ("1998-01-01", "1998-05-15"),
    "last 7 days": ("1998-05-08", "1998-05-15"),
    "last quarter": ("1998-01-01", "1998-03-31"),
    "Q3 1997": ("1997-07-01", "1997-09-30"),
}


@query(
    "time_ranges",
    " UNION ALL ".join(
        f"SELECT '{name}' AS range_name, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(24,6))) AS DOUBLE) AS amount "
        f"FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{a}' AND DATE '{b}'"
        for name, (a, b) in RANGES.items()
    ),
)
def time_ranges(t):
    """Each range is a pushed-down filter, so only its row groups are read."""
    orders = t("orders")
    return union_sources(
        [
            orders.filter(within("o_orderdate", name, day(TODAY))).agg(
                F.lit(name).alias("range_name"), F.count("*").alias("orders"), exact_sum("o_totalprice").alias("amount")
            )
            for name in RANGES
        ]
    )


@query("lookup", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'")
def lookup(t):
    found = t("customer").filter(F.col("c_name") == "Customer#000000042")
    return found.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query(
    "null_safe_ratio",
    """
    SELECT LOWER(c_mktsegment) AS segment, c_nationkey,
           COUNT(CASE WHEN c_acctbal > 9000 THEN 1 END) AS rich, COUNT(CASE WHEN c_acctbal < -800 THEN 1 END) AS poor,
           COUNT(CASE WHEN c_acctbal > 9000 THEN 1 END)
             / CAST(NULLIF(COUNT(CASE WHEN c_acctbal < -800 THEN 1 END), 0) AS DOUBLE) AS rich_per_poor,
           CAST(SUM(COALESCE(CAST(c_acctbal AS DECIMAL(24,6)), 0)) AS DOUBLE) AS balance
    FROM customer GROUP BY ALL
    """,
)
def null_safe_ratio(t):
    counts = t("customer").groupBy(F.lower("c_mktsegment").alias("segment"), "c_nationkey").agg(
        F.count_if(F.col("c_acctbal") > 9000).alias("rich"),
        F.count_if(F.col("c_acctbal") < -800).alias("poor"),
        exact_sum(F.coalesce("c_acctbal", F.lit(0.0))).alias("balance"),
    )
    return counts.withColumn("rich_per_poor", C.ratio(F.col("rich"), F.col("poor")))


@query(
    "date_parts",
    """
    SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INTEGER) AS year, CAST(MONTH(o_orderdate) AS INTEGER) AS month,
           CAST(DAY(o_orderdate) AS INTEGER) AS day, CAST(QUARTER(o_orderdate) AS INTEGER) AS quarter,
           strftime(o_orderdate, '%a') AS day_name, strftime(o_orderdate, '%b') AS month_name,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m') AS month_key,
           CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before
    FROM orders
    """,
)
def date_parts(t):
    d = "o_orderdate"
    return C.with_date_parts(t("orders"), d).select(
        "o_orderkey", "year", "month", "day",
        F.quarter(d).alias("quarter"),
        F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"),
        date_key(d).alias("date_key"),
        F.date_format(d, "yyyy-MM").alias("month_key"),
        F.date_sub(F.to_date(d), 1).cast("string").alias("day_before"),
    )


@query(
    "time_grain",
    " UNION ALL ".join(
        f"SELECT '{grain}' AS grain, CAST(CAST(date_trunc('{unit}', ts) AS DATE) AS VARCHAR) AS period, COUNT(*) AS events "
        "FROM events GROUP BY ALL"
        for grain, unit in GRAINS.items()
    ),
)
def time_grain(t):
    """Daily counts come from the scan; coarser grains roll up from the days."""
    days = t("events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return union_sources(
        [
            days.groupBy(grain_start("day", grain).cast("string").alias("period"))
            .agg(F.sum("n").alias("events"))
            .select(F.lit(grain).alias("grain"), "period", "events")
            for grain in GRAINS
        ]
    )


@query(
    "string_normalise",
    """
    SELECT p_partkey, UPPER(p_name) AS name_upper, LOWER(p_brand) AS brand_lower, p_name ILIKE '%RING%' AS is_ring,
           p_name LIKE 'small%' AS is_small, LENGTH(p_name) >= 10 AS is_long FROM part
    """,
)
def string_normalise(t):
    return t("part").select(
        "p_partkey",
        F.upper("p_name").alias("name_upper"),
        F.lower("p_brand").alias("brand_lower"),
        C.contains_ignoring_case("p_name", "RING").alias("is_ring"),
        F.col("p_name").like("small%").alias("is_small"),
        (F.length("p_name") >= 10).alias("is_long"),
    )


@query(
    "suffixed_scale",
    """
    SELECT c_custkey, CAST(CAST(FLOOR(c_acctbal) AS INTEGER) AS VARCHAR) || 'K' AS salary,
           CAST(CAST(FLOOR(c_acctbal) AS INTEGER) * CAST(0.9 AS DOUBLE) AS VARCHAR) || 'K' AS net_salary FROM customer
    """,
)
def suffixed_scale(t):
    rows = t("customer").select(
        "c_custkey", F.concat(F.floor("c_acctbal").cast("int").cast("string"), F.lit("K")).alias("salary")
    )
    return rows.withColumn("net_salary", C.scale_suffixed("salary", 0.9))


@query(
    "explode_array",
    """
    SELECT lang, COUNT(*) AS tokens, COUNT(DISTINCT token) AS distinct_tokens
    FROM (SELECT lang, UNNEST(string_split(text, ' ')) AS token FROM documents) GROUP BY lang
    """,
)
def explode_array(t):
    """Tokens per language; repeated tokens are folded before the shuffle."""
    tokens = t("documents").select("lang", F.explode(F.split("text", " ")).alias("token"))
    per_token = tokens.groupBy("lang", "token").agg(F.count("*").alias("n"))
    return per_token.groupBy("lang").agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct_tokens"))


@query(
    "nested_projection",
    f"WITH {CLICKSTREAM_SQL} SELECT event_id, device, unit, price FROM clickstream",
)
def nested_projection(t):
    return clickstream(t).select("event_id", "device", "ecommerce.unit", "ecommerce.price")
