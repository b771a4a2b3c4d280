"""Bounded results: top rows in a total order, and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_rows(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows; end ``order`` with a unique column. No global sort takes place."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Some ``n`` rows, for people to look at."""
    return df.limit(n)
