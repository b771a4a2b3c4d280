"""Projections, predicates and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Device status -> category, device event type -> code.
STATUS_CATEGORY = {"active": "Operational", "inactive": "Standby", "faulty": "Requires Maintenance"}
STATUS_DEFAULT = "Unknown"
EVENT_CODE = {"sensor_reading": "E101", "alert": "E202", "heartbeat": "E303"}
EVENT_CODE_DEFAULT = "E000"
# Traffic source -> campaign type.
CAMPAIGNS = [
    ("email", "retention"),
    ("facebook", "acquisition"),
    ("google", "paid_search"),
    ("twitter", "awareness"),
]


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_or_null(text: Column, kind: str) -> Column:
    """Text as a number, NULL when it is none.

    A cheap pattern skips text that cannot be a number: a failed parse costs an
    exception per row.
    """
    may_parse = text.rlike("[0-9]") if kind in ("int", "bigint") else text.rlike("(?i)[0-9]|inf|nan")
    return F.when(may_parse, text.try_cast(kind))


def _mapped_value(source: str, source_kind: str, kind: str) -> Column:
    kind = {"long": "bigint", "integer": "int"}.get(kind, kind)
    if source_kind == "string" and kind in ("int", "bigint", "double"):
        return number_or_null(F.col(source), kind)
    return F.col(source).try_cast(kind)


def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rename and cast by ``(source, source type, target, target type)``.

    Unlisted columns are dropped; a value that does not fit the target type
    becomes NULL. Back-quote a source whose name holds dots or brackets.
    """
    return df.select(
        *[_mapped_value(src, src_kind, kind).alias(dst) for src, src_kind, dst, kind in mappings]
    )


def mapped(value: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """Dictionary lookup with a default for unknown and NULL values."""
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(lookup[column(value)], F.lit(default))


def with_date_parts(df: DataFrame, timestamp: str = "created_at") -> DataFrame:
    """Partition columns year, month, day of a timestamp."""
    return df.withColumns(
        {"year": F.year(timestamp), "month": F.month(timestamp), "day": F.dayofmonth(timestamp)}
    )


def change_action(is_new: Column, is_changed: Column) -> Column:
    return (
        F.when(is_new, F.lit("INSERT_NEW"))
        .when(is_changed, F.lit("UPDATE_EXISTING"))
        .otherwise(F.lit("NO_CHANGE"))
    )


def any_difference(old: Sequence[Column], new: Sequence[Column], null_safe: bool = False) -> Column:
    """True when some attribute differs.

    With plain ``<>`` a change from or to NULL is not seen; ``null_safe`` sees it.
    """
    pairs = list(zip(old, new, strict=True))
    if null_safe:
        return reduce(lambda a, b: a | b, [~o.eqNullSafe(n) for o, n in pairs])
    return F.coalesce(reduce(lambda a, b: a | b, [o != n for o, n in pairs]), F.lit(False))


def priority_level(category: Column, code: Column) -> Column:
    urgent = (category == "Requires Maintenance") | (code == "E202")
    return F.when(urgent, F.lit("High")).otherwise(F.lit("Normal"))


def geo_region(latitude: Column, longitude: Column) -> Column:
    """Hemisphere names; zero counts as southern and western."""
    north = F.when(latitude > 0, F.lit("Northern Hemisphere")).otherwise(F.lit("Southern Hemisphere"))
    east = F.when(longitude > 0, F.lit("Eastern")).otherwise(F.lit("Western"))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.concat_ws(", ", north, east))


def grid_key(latitude: Column, longitude: Column) -> Column:
    return F.concat(
        F.round(latitude, 2).cast("string"), F.lit("|"), F.round(longitude, 2).cast("string")
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def scale_suffixed(value: Column | str, factor: float, suffix: str = "K") -> Column:
    """``"100K"`` scaled by 0.9 gives ``"90.0K"``; text without a leading integer gives NULL."""
    text = column(value)
    number = F.substring(text, F.lit(1), F.length(text) - 1).try_cast("int")
    return F.concat((number * F.lit(factor)).cast("string"), F.lit(suffix))


def compact_number(value: Column | str, prefix: str = "") -> Column:
    """``4200000`` as ``4.2M``, ``127000`` as ``127K``; one decimal, dropped when zero."""
    v = column(value)
    size = F.abs(v)

    def scaled(unit: float, letter: str) -> Column:
        shown = F.regexp_replace(F.format_string("%.1f", size / F.lit(unit)), r"\.0$", "")
        return F.concat(shown, F.lit(letter))

    body = (
        F.when(size >= 1e9, scaled(1e9, "B"))
        .when(size >= 1e6, scaled(1e6, "M"))
        .when(size >= 1e3, scaled(1e3, "K"))
        .otherwise(scaled(1.0, ""))
    )
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), F.lit(prefix), body)


def percent_text(share: Column | str) -> Column:
    return F.format_string("%.1f%%", column(share) * 100.0)


def contains_ignoring_case(text: Column | str, part: str) -> Column:
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return column(text).ilike(f"%{escaped}%")


def iso_time(value: Column | str) -> Column:
    return F.try_to_timestamp(column(value))


def epoch_time(seconds: Column | str) -> Column:
    return F.timestamp_seconds(column(seconds))
