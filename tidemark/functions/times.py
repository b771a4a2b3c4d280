"""Dates, grains and named time ranges. "Today" is always passed in."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grain name -> date_trunc unit.
GRAINS = {"daily": "day", "weekly": "week", "monthly": "month", "quarterly": "quarter", "yearly": "year"}


def month_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_key(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def grain_start(day: Column | str, grain: str) -> Column:
    return F.date_trunc(GRAINS[grain], day).cast("date")


def time_range(name: str, today: Column) -> tuple[Column, Column]:
    """Inclusive first and last day of a named range.

    Names: ``last month``, ``ytd``, ``last 7 days``, ``last quarter``, ``Qn yyyy``.
    """
    key = name.strip().lower()
    if key == "last month":
        first = F.trunc(F.add_months(today, -1), "month")
        return first, F.last_day(first)
    if key == "ytd":
        return F.trunc(today, "year"), today
    if key == "last 7 days":
        return F.date_sub(today, 7), today
    if key == "last quarter":
        this_quarter = F.trunc(today, "quarter")
        return F.add_months(this_quarter, -3), F.date_sub(this_quarter, 1)
    named = re.fullmatch(r"q([1-4]) (\d{4})", key)
    if named:
        first = F.make_date(F.lit(int(named[2])), F.lit(3 * int(named[1]) - 2), F.lit(1))
        return first, F.last_day(F.add_months(first, 2))
    raise ValueError(f"unknown time range {name!r}")


def within(day: Column | str, name: str, today: Column) -> Column:
    """Predicate on the raw column, so it reaches the scan as a pushed filter.

    The upper bound is exclusive on the next day, which also keeps timestamps
    late on the last day.
    """
    first, last = time_range(name, today)
    value = F.col(day) if isinstance(day, str) else day
    return (value >= first.cast("timestamp_ntz")) & (value < F.date_add(last, 1).cast("timestamp_ntz"))
