"""Wide sales table to 3NF entities to a star; order landing to a monthly table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_sum
from tidemark.functions.times import date_key, month_key
from tidemark.operators.dimensions import DuplicateKeys, date_dimension, entity, surrogate_key
from tidemark.operators.ordering import number_rows
from tidemark.operators.quality import duplicate_keys
from tidemark.sources.scratch import written
from tidemark.sources.sinks import create_or_replace, insert_append, insert_overwrite, overwrite_partitions


@dataclass(frozen=True)
class Entities:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame


CUSTOMER_ATTRIBUTES = ["customer_name", "customer_email", "customer_address"]
PRODUCT_ATTRIBUTES = ["product_name", "product_category", "product_price"]


def normalise(wide: DataFrame, number_items: bool = True, unique: bool = False) -> Entities:
    """Customers, products, orders and items of a wide sales table, keyed from 1.

    The wide table is written once, so the joins behind it run once; heads,
    products and items read their columns from the copy. Customers and orders
    both come from the distinct order heads, which are written too. Item keys
    need no order, so items are numbered where they lie; ``number_items=False``
    leaves them without a key. Two variants of a customer's or a product's
    attributes give two rows, and with ``unique`` an error.
    """
    wide = written(wide, "wide")
    heads = written(
        wide.select("order_id", "order_date", "customer_id", *CUSTOMER_ATTRIBUTES).distinct(), "order-heads"
    )
    customers = entity(heads, "customer_id", CUSTOMER_ATTRIBUTES, "customer_sk")
    products = entity(wide, "product_id", PRODUCT_ATTRIBUTES, "product_sk")
    if unique:
        for rows, key in ((customers, "customer_id"), (products, "product_id")):
            if not duplicate_keys(rows, [key]).isEmpty():
                raise DuplicateKeys(f"{key} has rows with different attributes")
    placed = heads.select("order_id", "order_date", "customer_id").distinct()
    orders = surrogate_key(
        placed.join(customers.select("customer_id", "customer_sk"), "customer_id").drop("customer_id").distinct(),
        "order_sk", ["order_id", "order_date", "customer_sk"],
    )
    items = (
        wide.select("order_id", "product_id", "quantity", "total_price")
        .join(orders.select("order_id", "order_sk"), "order_id")
        .join(products.select("product_id", "product_sk"), "product_id")
        .select("order_sk", "product_sk", "quantity", F.col("total_price").alias("item_total_price"))
    )
    return Entities(customers, products, orders, number_rows(items, "order_item_sk") if number_items else items)


def customer_dimension(customers: DataFrame) -> DataFrame:
    """The staging key becomes the warehouse key."""
    return customers.select(
        F.col("customer_sk").alias("customer_key"), "customer_id", *CUSTOMER_ATTRIBUTES
    )


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select(F.col("product_sk").alias("product_key"), "product_id", *PRODUCT_ATTRIBUTES)


def day_dimension(wide: DataFrame) -> DataFrame:
    return date_dimension(wide, "order_date")


def sales_fact(e: Entities) -> DataFrame:
    """Star fact. Unit price is the dimension's, and the total follows from it.

    The staging keys are the warehouse keys, so items join each dimension once by key.
    """
    buyers = customer_dimension(e.customers).select("customer_key")
    goods = product_dimension(e.products).select("product_key", "product_price")
    return (
        e.order_items.join(e.orders.select("order_sk", "order_date", "customer_sk"), "order_sk")
        .join(buyers, F.col("customer_sk") == F.col("customer_key"))
        .join(goods, F.col("product_sk") == F.col("product_key"))
        .select(
            "order_sk",
            "customer_key",
            "product_key",
            date_key("order_date").alias("date_key"),
            "quantity",
            F.col("product_price").alias("unit_price"),
            (F.col("quantity") * F.col("product_price")).cast("decimal(18,2)").alias("total_sales_amount"),
        )
    )


def bronze_orders(landing: DataFrame, load_time: Column) -> DataFrame:
    return landing.select(
        "order_id",
        "product_id",
        "customer_id",
        "quantity",
        (F.col("quantity") * F.col("price_per_unit")).alias("total_price"),
        F.to_date("order_date").alias("order_date"),
        "region",
        load_time.alias("load_timestamp"),
    )


def monthly_sales(bronze: DataFrame) -> DataFrame:
    """Sales and quantity per product, region and ``yyyy-MM`` month."""
    return bronze.groupBy("product_id", "region", month_key("order_date").alias("month")).agg(
        exact_sum("total_price").alias("total_sales"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
    )


def load_monthly(
    landing: DataFrame, load_time: Column, bronze_table: str, monthly_table: str, append: bool = False,
) -> None:
    """Replace the bronze table, then load the monthly table from it.

    A re-run leaves the same monthly rows; ``append`` adds them again, as a
    plain insert would.
    """
    spark = landing.sparkSession
    create_or_replace(bronze_orders(landing, load_time), bronze_table)
    monthly = monthly_sales(spark.table(bronze_table))
    if not spark.catalog.tableExists(monthly_table):
        create_or_replace(monthly.limit(0), monthly_table)
    (insert_append if append else insert_overwrite)(monthly, monthly_table)


def load_months(landing: DataFrame, load_time: Column, bronze_path: str, monthly_path: str) -> None:
    """Load whole months: both layers are partitioned by month, and only the months of ``landing`` are replaced.

    ``landing`` holds all orders of the months it delivers, as a rerun does; orders without a
    date are the month ``unknown``. The monthly layer is summed from the bronze months
    just written; Spark prunes the others from the scan.
    """
    spark = landing.sparkSession
    named = lambda df, month: df.withColumn("month", F.coalesce(month, F.lit("unknown")))
    bronze = named(bronze_orders(landing, load_time), month_key("order_date"))
    overwrite_partitions(bronze, bronze_path, ["month"])
    touched = bronze.select(F.col("month").alias("_month")).distinct()
    stored = spark.read.schema(bronze.schema).parquet(bronze_path)
    fresh = stored.join(touched, F.col("month") == F.col("_month"), "left_semi")
    overwrite_partitions(named(monthly_sales(fresh), F.col("month")), monthly_path, ["month"])
