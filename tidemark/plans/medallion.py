"""Clickstream from bronze to silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.functions.numbers import exact_total
from tidemark.operators.joins import enrich_campaign
from tidemark.operators.sets import union_sources
from tidemark.sources.sinks import export_single_csv, overwrite_layer

REQUIRED = ["device", "unit", "price", "event_name", "traffic_source"]


def silver(bronze: DataFrame) -> DataFrame:
    """Flatten the nested fields, drop incomplete rows, add the campaign."""
    flat = bronze.select("device", "ecommerce.unit", "ecommerce.price", "event_name", "traffic_source")
    return enrich_campaign(flat.dropna(subset=REQUIRED))


def gold_base(silver_rows: DataFrame, order_event: str = "order placed", cart_event: str = "add to cart") -> DataFrame:
    """One pre-aggregated row per device and source; all four KPIs roll up from it."""
    is_order, is_cart = F.col("event_name") == order_event, F.col("event_name") == cart_event
    return silver_rows.groupBy("device", "traffic_source").agg(
        exact_total(F.col("price") * F.col("unit")).alias("sales"),
        F.count_if(is_order).alias("orders"),
        F.count_if(is_cart).alias("carts"),
    )


def gold(base: DataFrame) -> dict[str, DataFrame]:
    by_device = base.groupBy("device").agg(
        F.sum("sales").cast("double").alias("total_sales"),
        F.sum("orders").alias("orders"),
        F.sum("carts").alias("carts"),
    )
    return {
        "sales_by_device": by_device.select("device", "total_sales").orderBy("total_sales"),
        "sales_by_traffic": base.groupBy("traffic_source")
        .agg(F.sum("sales").cast("double").alias("total_sales"))
        .orderBy("total_sales"),
        "orders": base.filter("orders > 0")
        .select("device", "traffic_source", F.col("orders").alias("total_orders"))
        .orderBy("total_orders"),
        "conversion": by_device.select(
            "device", "orders", "carts", ratio(F.col("orders"), F.col("carts")).alias("conversion_rate")
        ),
    }


def gold_rows(kpis: dict[str, DataFrame]) -> DataFrame:
    """The four KPIs as one long frame ``(kpi, device, traffic_source, value)``."""
    value = {
        "sales_by_device": "total_sales",
        "sales_by_traffic": "total_sales",
        "orders": "total_orders",
        "conversion": "conversion_rate",
    }
    none = F.lit(None).cast("string")
    return union_sources(
        [
            df.select(
                F.lit(name).alias("kpi"),
                *[(F.col(c) if c in df.columns else none).alias(c) for c in ("device", "traffic_source")],
                F.col(value[name]).cast("double").alias("value"),
            )
            for name, df in kpis.items()
        ]
    )


def run(source: DataFrame, folder: str, **events: str) -> dict[str, DataFrame]:
    """Write bronze, silver and the four gold CSV exports under ``folder``."""
    bronze = overwrite_layer(source, f"{folder}/bronze")
    cleaned = overwrite_layer(silver(bronze), f"{folder}/silver")
    base = overwrite_layer(gold_base(cleaned, **events), f"{folder}/gold_base")
    kpis = gold(base)
    for name, kpi in kpis.items():
        export_single_csv(kpi, f"{folder}/gold/kpi_{name}.csv")
    return kpis
