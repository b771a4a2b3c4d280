"""Ranking, versions and comparisons over groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.operators.ordering import exact_median, running_total


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Best row per group, ties kept.

    The ``rank() = 1`` filter lets Spark cut each group before the shuffle, so a
    hot group sends only its leaders.
    """
    return qualify(df, F.rank().over(Window.partitionBy(*groups).orderBy(*order)), 1)


def qualify(df: DataFrame, ranking: Column, keep: int) -> DataFrame:
    """Rows whose window rank is at most ``keep``."""
    return df.withColumn("_rank", ranking).filter(F.col("_rank") <= keep).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key. End ``newest_first`` with a unique column for a fixed result."""
    return qualify(df, F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)), 1)


def version_number(
    df: DataFrame, keys: Sequence[str], levels: Sequence[tuple[str, Column]],
    order_by: Sequence[Column | str], out: str = "version",
) -> DataFrame:
    """1, 2, 3 ... per key in effective order (see ``running_total`` for ``levels``)."""
    return running_total(df, keys, levels, order_by, F.lit(1).cast("bigint"), out)


def period_growth(df: DataFrame, groups: Sequence[str], period: str, measure: str) -> DataFrame:
    """Percent change against the previous period of the group.

    Expects one row per group and period, so a window holds no more rows than
    there are periods.
    """
    previous = F.lag(measure).over(Window.partitionBy(*groups).orderBy(period))
    current = F.col(measure)
    return df.withColumn("previous", previous).withColumn(
        "growth_pct", ratio((current - F.col("previous")) * 100.0, F.col("previous"))
    )


def magnitude_outliers(df: DataFrame, measure: str, factor: float = 10.0) -> DataFrame:
    """Rows whose measure is ``factor`` times above or below the median of all rows."""
    median = exact_median(df, measure).scalar()
    with_median = df.withColumn("median", median)
    size, middle = F.abs(measure), F.abs("median")
    far = (size >= middle * factor) | (size * factor <= middle)
    return with_median.filter(far).withColumn(
        "direction", F.when(size > middle, F.lit("above")).otherwise(F.lit("below"))
    )
