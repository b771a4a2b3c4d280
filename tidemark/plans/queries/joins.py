"""Join, set and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import sets as S
from tidemark.operators.search import merged_candidates
from tidemark.operators.topk import top_rows
from tidemark.plans.registry import query
from tidemark.plans.views import CLICKSTREAM_SQL, clickstream


@query(
    "join_inner",
    """
    SELECT o_orderkey, c_custkey, c_name, c_mktsegment, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def join_inner(t):
    joined = J.join_by_name(t("customer"), t("orders"), F.col("c_custkey") == F.col("o_custkey"), "INNER")
    return joined.select("o_orderkey", "c_custkey", "c_name", "c_mktsegment", "o_totalprice")


@query(
    "campaign_enrich",
    f"""
    WITH {CLICKSTREAM_SQL}
    SELECT event_id, traffic_source, CASE traffic_source WHEN 'email' THEN 'retention' WHEN 'facebook' THEN 'acquisition'
           WHEN 'google' THEN 'paid_search' WHEN 'twitter' THEN 'awareness' END AS campaign_type FROM clickstream
    """,
)
def campaign_enrich(t):
    return J.enrich_campaign(clickstream(t).select("event_id", "traffic_source"))


def _orders(t):
    return t("orders").select("o_orderkey", "o_custkey")


@query(
    "join_left",
    f"""
    SELECT c_custkey, c_name, COALESCE(o_orderkey, -1) AS o_orderkey
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    """,
)
def join_left(t):
    joined = J.join_by_name(t("customer"), _orders(t), F.col("c_custkey") == F.col("o_custkey"), "LEFT")
    return joined.select("c_custkey", "c_name", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"))


@query(
    "join_right",
    f"""
    SELECT c_custkey, c_name, COALESCE(o_orderkey, -1) AS o_orderkey
    FROM orders RIGHT JOIN customer ON c_custkey = o_custkey
    """,
)
def join_right(t):
    joined = J.join_by_name(_orders(t), t("customer"), F.col("c_custkey") == F.col("o_custkey"), "RIGHT")
    return joined.select("c_custkey", "c_name", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"))


@query(
    "join_full",
    """
    SELECT COALESCE(c.nationkey, s.nationkey) AS nationkey, COALESCE(customers, 0) AS customers,
           COALESCE(suppliers, 0) AS suppliers
    FROM (SELECT c_nationkey AS nationkey, COUNT(*) AS customers FROM customer GROUP BY 1) c
    FULL JOIN (SELECT s_nationkey AS nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1) s
      ON c.nationkey = s.nationkey
    """,
)
def join_full(t):
    c = t("customer").groupBy(F.col("c_nationkey").alias("nationkey"))
    s = t("supplier").groupBy(F.col("s_nationkey").alias("nationkey"))
    joined = J.join_by_name(
        c.agg(F.count("*").alias("customers")), s.agg(F.count("*").alias("suppliers")), ["nationkey"], "FULL"
    )
    return joined.fillna(0, ["customers", "suppliers"])


# Declared references (child table, child key, parent table, parent key).
REFERENCES = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
]


@query(
    "fk_orphans",
    " UNION ALL ".join(
        f"SELECT '{child}.{ck}' AS reference, COUNT(*) AS orphans FROM {child} a WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} b WHERE b.{pk} = a.{ck})"
        for child, ck, parent, pk in REFERENCES
    ),
)
def fk_orphans(t):
    """Children without a parent, per reference; the last two count missing children. Rows are counted per key before the join."""
    counts = []
    for child, ck, parent, pk in REFERENCES:
        keys = t(parent).select(F.col(pk).alias("_parent"))
        held = t(child).groupBy(ck).agg(F.count("*").alias("_rows"))
        lost = J.orphans(held, keys, ck, "_parent")
        counts.append(lost.agg(F.lit(f"{child}.{ck}").alias("reference"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans")))
    return S.union_sources(counts)


@query(
    "fk_matched",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    """,
)
def fk_matched(t):
    buyers = t("orders").select("o_custkey")
    return J.matched(t("customer"), buyers, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "union_all",
    """
    SELECT 'customer' AS source, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL FROM supplier
    """,
)
def union_all(t):
    c = t("customer").select(
        F.lit("customer").alias("source"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = t("supplier").select(
        F.lit("supplier").alias("source"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return S.union_sources([c, s])


@query(
    "union_topk",
    """
    SELECT name, COALESCE(score, 0) AS score FROM (
      SELECT c_name AS name, c_acctbal AS score FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier
      UNION ALL SELECT n_name, NULL FROM nation)
    ORDER BY COALESCE(score, 0) DESC, name LIMIT 10
    """,
)
def union_topk(t):
    c = t("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("score"))
    s = t("supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("score"))
    return S.merge_top([c, s, t("nation").select(F.col("n_name").alias("name"))], 10, ["name"])


@query(
    "set_intersect",
    """
    SELECT p_brand, p_type, p_size FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_returnflag = 'A'
    INTERSECT
    SELECT p_brand, p_type, p_size FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_returnflag = 'R'
    """,
)
def set_intersect(t):
    """Parts and flags are made distinct first, so the join sees each part once per flag."""
    pairs = t("lineitem").filter(F.col("l_returnflag").isin("A", "R")).select("l_partkey", "l_returnflag").distinct()
    sold = pairs.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    side = lambda flag: sold.filter(F.col("l_returnflag") == flag).select("p_brand", "p_type", "p_size")
    return side("A").intersect(side("R"))


@query(
    "expected_recall",
    """
    SELECT user_id, (CAST(BOOL_OR(event_type = 'view') AS INTEGER) + CAST(BOOL_OR(event_type = 'click') AS INTEGER)
                     + CAST(BOOL_OR(event_type = 'purchase') AS INTEGER)) / 3.0::DOUBLE AS recall
    FROM events GROUP BY user_id
    """,
)
def expected_recall(t):
    found = t("events").groupBy("user_id").agg(F.collect_set("event_type").alias("found"))
    expected = F.array(F.lit("View"), F.lit("click"), F.lit("purchase"))
    return found.select("user_id", S.recall(expected, F.col("found")).alias("recall"))


@query(
    "date_gaps",
    """
    WITH d AS (SELECT DISTINCT day FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS day FROM orders GROUP BY o_custkey)),
    calendar AS (SELECT CAST(UNNEST(generate_series((SELECT MIN(day) FROM d), (SELECT MAX(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT CAST(day AS VARCHAR) AS day FROM calendar WHERE day NOT IN (SELECT day FROM d)
    """,
)
def date_gaps(t):
    """Days on which no customer placed a first order."""
    first = t("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("o_orderdate"))
    return S.missing_days(first, "o_orderdate").select(F.col("day").cast("string").alias("day"))


@query(
    "dedup_candidates",
    """
    SELECT table_key, name, source, width FROM (
      SELECT LOWER(p_name) AS table_key, name, source, width,
             ROW_NUMBER() OVER (PARTITION BY LOWER(p_name) ORDER BY width DESC, source, name) AS rn
      FROM (SELECT p_name, concat_ws('.', p_type, p_name) AS name, p_brand AS source, p_size AS width FROM part))
    WHERE rn = 1
    """,
)
def dedup_candidates(t):
    candidates = t("part").select(
        F.concat_ws(".", "p_type", "p_name").alias("name"),
        F.col("p_brand").alias("source"),
        F.array_repeat(F.lit("column"), F.col("p_size")).alias("columns"),
    )
    return merged_candidates(candidates).select("table_key", "name", "source", F.size("columns").alias("width"))


@query(
    "top3_products",
    """
    SELECT p_name, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity_sold
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name ORDER BY 2 DESC, 1 LIMIT 3
    """,
)
def top3_products(t):
    """Quantities are summed per part before the join, so the join moves one row per part."""
    per_part = t("lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    named = per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    totals = named.groupBy("p_name").agg(F.sum("q").alias("total_quantity_sold"))
    return top_rows(totals, [F.desc("total_quantity_sold"), "p_name"], 3)


@query("top_customers", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5")
def top_customers(t):
    rows = t("customer").select("c_custkey", "c_name", "c_acctbal")
    return top_rows(rows, [F.desc("c_acctbal"), "c_custkey"], 5)
