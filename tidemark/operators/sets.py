"""Unions, intersections and gaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all sources; a column some source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_top(frames: Sequence[DataFrame], k: int, tie_break: Sequence[str]) -> DataFrame:
    """Best ``k`` rows over all sources by score; a missing score counts as zero."""
    scored = union_sources(frames).withColumn("score", F.coalesce(F.col("score"), F.lit(0.0)))
    return scored.orderBy(F.desc("score"), *tie_break).limit(k)


def recall(expected: Column, found: Column) -> Column:
    """Share of expected names that were found, ignoring case; 1 when none is expected."""
    lowered = lambda a: F.array_distinct(F.transform(a, F.lower))
    hits = F.size(F.array_intersect(lowered(expected), lowered(found))).cast("double")
    wanted = F.size(lowered(expected)).cast("double")
    return F.when(F.coalesce(F.size(expected), F.lit(0)) <= 0, F.lit(1.0)).otherwise(hits / wanted)


def missing_days(df: DataFrame, day: str) -> DataFrame:
    """Days between the first and the last one that have no row."""
    days = df.select(F.to_date(day).alias("day")).distinct().filter("day IS NOT NULL")
    bounds = days.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    return calendar.join(days, "day", "left_anti")
