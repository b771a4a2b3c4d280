"""Three retail KPIs from one selection of outlet sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import apply_mapping
from tidemark.functions.numbers import exact_total
from tidemark.operators.aggregates import aggregate
from tidemark.sources.sinks import export_csv

SELECTION = ["outlet_size", "outlet_location_type", "item_outlet_sales", "outlet_type", "item_type"]

# Grouping and output names of each KPI.
KPIS = {
    "location_outlet": (["outlet_location_type", "outlet_size"], "Total_Sales", "Item_Sold"),
    "sales_item_type": (["item_type"], "Total_Outlet_Sales", "Count_Items_Sold"),
    "outlet_location_item": (
        ["outlet_type", "outlet_location_type", "item_type"], "Total_Sales", "Total_Item_Sold",
    ),
}


def kpis(selection: DataFrame) -> dict[str, DataFrame]:
    """All three KPIs. Sums and counts roll up from one aggregate at the finest grain."""
    grain = [c for c in SELECTION if c != "item_outlet_sales"]
    base = selection.groupBy(*grain).agg(
        exact_total("item_outlet_sales").alias("_sales"), F.count("item_type").alias("_items")
    )
    out = {}
    for name, (groups, total, sold) in KPIS.items():
        rolled = aggregate(base, groups, [("_sales", "sum"), ("_items", "sum")])
        mapping = [(g, "string", g, "string") for g in groups]
        mapping += [("`sum(_sales)`", "decimal", total, "double"), ("`sum(_items)`", "long", sold, "long")]
        out[name] = apply_mapping(rolled, mapping)
    return out


def run(sales: DataFrame, folder: str) -> None:
    """Export the three KPIs as CSV."""
    for name, kpi in kpis(sales.select(*SELECTION)).items():
        export_csv(kpi, f"{folder}/{name}")
