"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column, ratio

# Aggregates that may be chosen by name.
BY_NAME = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "min": F.min,
    "max": F.max,
}


def named_aggregate(func: str, value: Column | str) -> Column:
    if func not in BY_NAME:
        raise ValueError(f"aggregate {func!r} is not one of {sorted(BY_NAME)}")
    return BY_NAME[func](value)


def aggregate(df: DataFrame, groups: Sequence[str], aggs: Sequence[tuple[str, str]]) -> DataFrame:
    """Aggregates given as ``(column, function name)``; no groups gives one global row.

    Result columns are named ``function(column)``.
    """
    measures = [named_aggregate(func, name).alias(f"{func}({name})") for name, func in aggs]
    return df.groupBy(*groups).agg(*measures)


def grouped(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], order: Sequence[Column | str] = (),
) -> DataFrame:
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    return out.orderBy(*order) if order else out


def conditional_count(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def conversion(df: DataFrame, keys: Sequence[str], done: Column, started: Column) -> DataFrame:
    """Counts of finished and started actions and their quotient (NULL for zero started)."""
    return (
        df.groupBy(*keys)
        .agg(conditional_count(done).alias("orders"), conditional_count(started).alias("carts"))
        .withColumn("conversion_rate", ratio(F.col("orders"), F.col("carts")))
    )


def with_share(groups: DataFrame, measure: str, out: str = "share") -> DataFrame:
    """Share of the grand total, which is a scalar subquery rather than one global window."""
    total = groups.agg(F.sum(measure)).scalar()
    return groups.withColumn(out, ratio(column(measure), total))
