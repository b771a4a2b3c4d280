"""Sums over double columns that no plan changes.

Sums of doubles depend on the order of the addends, hence on the partitioning.
Measures are therefore counted in whole units of ``10**-SCALE`` as long integers:
any plan gives the same total, and the work stays in generated code without
per-row decimal objects. ``SCALE`` leaves room for prices with fractions of a
cent; products are multiplied first and counted then. A value too large for a long
integer of such units is counted as a decimal instead, in a sum of its own. NaN and
the infinities count as NULL; a finite value beyond 10**24 is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import column

_LOW_BITS = 20
SCALE = 6


def units(value: Column | str, scale: int = SCALE) -> Column:
    """Value as a whole number of ``10**-scale`` units."""
    return F.rint(column(value) * float(10**scale)).try_cast("bigint")


def sum_units(whole: Column, scale: int = SCALE) -> Column:
    """Exact decimal sum of unit counts.

    High and low bits are added apart, so no long sum overflows however many
    rows there are.
    """
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(22,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(22,0)")
    total = high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low
    return (total * F.lit(10.0**-scale).cast(f"decimal({scale},{scale})")).cast(f"decimal(36,{scale})")


def is_number(value: Column | str) -> Column:
    """Whether a double is there, and neither NaN nor infinite."""
    return F.abs(column(value)) < float("inf")


def exact_total(value: Column | str, scale: int = SCALE) -> Column:
    """Exact decimal sum; NULL without a number."""
    whole = units(value, scale)
    large = F.when(whole.isNull() & is_number(value), column(value).cast(f"decimal({24 + scale},{scale})"))
    small_sum, large_sum = sum_units(whole, scale), F.sum(large).cast(f"decimal(36,{scale})")
    none = F.lit(0).cast(f"decimal(36,{scale})")
    both = (F.coalesce(small_sum, none) + F.coalesce(large_sum, none)).cast(f"decimal(36,{scale})")
    return F.when(F.count(large) > 0, both).otherwise(small_sum)


def exact_sum(value: Column | str, scale: int = SCALE) -> Column:
    return exact_total(value, scale).cast("double")


def exact_avg(value: Column | str, scale: int = SCALE) -> Column:
    return F.try_divide(exact_sum(value, scale), F.count(F.when(is_number(value), 1)).cast("double"))


def money(value: Column | str, scale: int = 2) -> Column:
    """Money as a decimal, for row-level arithmetic."""
    return column(value).cast(f"decimal(18,{scale})")


def net_price() -> Column:
    """Extended price after discount."""
    return F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
