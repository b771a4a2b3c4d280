"""Surrogate keys, slowly changing dimensions and entity extraction.

Plain Parquet has no MERGE. Each operator returns the next state of the table
as a new frame; callers write it beside the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import any_difference, change_action
from tidemark.functions.times import date_key
from tidemark.operators.ordering import number_rows
from tidemark.operators.sets import union_sources

HIGH_DATE = "9999-12-31"


class DuplicateKeys(ValueError):
    """A load batch names the same natural key more than once."""


def surrogate_key(df: DataFrame, out: str, order_by: Sequence[str], start: int | Column = 1) -> DataFrame:
    """Dense identity column; ``start`` continues an earlier load."""
    return number_rows(df, out, order_by, start)


def entity(df: DataFrame, natural_key: str, attributes: Sequence[str], key_name: str) -> DataFrame:
    """Distinct entity rows of a wide table with a surrogate key.

    Two attribute variants of one natural key give two rows, as DISTINCT does.
    """
    rows = df.select(natural_key, *attributes).distinct()
    return surrogate_key(rows, key_name, [natural_key, *attributes])


def date_dimension(df: DataFrame, day: str) -> DataFrame:
    """One row per date present in the data."""
    days = df.select(F.to_date(day).alias("full_date")).distinct().filter("full_date IS NOT NULL")
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.dayname("full_date").alias("day_of_week"),
        F.monthname("full_date").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
    )


def _both(names: Sequence[str]) -> tuple[list[Column], list[Column]]:
    return [F.col(f"t.{n}") for n in names], [F.col(f"s.{n}") for n in names]


def one_row_per_key(batch: DataFrame, key: str, newest: Sequence[Column | str] = ()) -> DataFrame:
    """The batch with one row per key, as a merge needs it; rows without a key stay.

    ``newest`` orders the rows of a key, the one to keep first. What it leaves
    open, the largest values of the other columns decide, so reruns agree.
    """
    rest = [F.desc_nulls_last(c) for c in batch.columns if c != key]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*newest, *rest))
    ranked = batch.withColumn("_rank", rank)
    return ranked.filter((F.col("_rank") == 1) | F.col(key).isNull()).drop("_rank")


def scd1_merge(
    target: DataFrame, source: DataFrame, key: str, attributes: Sequence[str],
    load_time: str, now: Column, null_safe: bool = False, newest: Sequence[Column | str] = (),
) -> DataFrame:
    """Type 1: update changed rows in place, insert new ones, delete none.

    ``load_time`` moves only for touched rows. A key that the batch repeats
    counts once (see :func:`one_row_per_key`).
    """
    sent = one_row_per_key(source, key, newest).withColumn("_sent", F.lit(True))
    held = target.withColumn("_held", F.lit(True))
    joined = held.alias("t").join(sent.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    absent, matched = F.col("_held").isNull(), F.col("_sent").isNotNull()
    old, new = _both(attributes)
    touched = matched & (absent | any_difference(old, new, null_safe))
    return joined.select(
        F.coalesce(f"t.{key}", f"s.{key}").alias(key),
        *[F.when(touched, n).otherwise(o).alias(name) for name, o, n in zip(attributes, old, new, strict=True)],
        F.when(touched, now).otherwise(F.col(f"t.{load_time}")).alias(load_time),
    )


def scd0_insert(target: DataFrame, source: DataFrame, key: str, newest: Sequence[Column | str] = ()) -> DataFrame:
    """Type 0: original values stay; only unknown keys are added, each once."""
    fresh = one_row_per_key(source, key, newest).select(*target.columns).join(target.select(key), key, "left_anti")
    return target.unionByName(fresh)


def scd3_merge(target: DataFrame, source: DataFrame, key: str, tracked: str, newest: Sequence[Column | str] = ()) -> DataFrame:
    """Type 3: ``previous_<tracked>`` keeps the value before the latest change; a repeated key counts once."""
    source = one_row_per_key(source, key, newest)
    previous = f"previous_{tracked}"
    others = [c for c in source.columns if c not in (key, tracked) and c in target.columns]
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    known, sent = F.col(f"t.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    old, new = F.col(f"t.{tracked}"), F.col(f"s.{tracked}")
    changed = known & sent & F.coalesce(old != new, F.lit(False))
    kept = F.col(f"t.{previous}") if previous in target.columns else F.lit(None)
    return joined.select(
        F.coalesce(f"t.{key}", f"s.{key}").alias(key),
        *[F.when(sent, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in others],
        F.when(sent, new).otherwise(old).alias(tracked),
        F.when(changed, old).otherwise(kept).cast(target.schema[tracked].dataType).alias(previous),
    )


def scd4_split(
    target: DataFrame, source: DataFrame, key: str, attributes: Sequence[str], load_time: str, now: Column,
    newest: Sequence[Column | str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Type 4: the merged current table, and the replaced rows for the history table; a repeated key counts once."""
    source = one_row_per_key(source, key, newest)
    current = scd1_merge(target, source, key, attributes, load_time, now)
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"))
    replaced = joined.filter(any_difference(*_both(attributes))).select(
        "t.*", now.alias("replaced_at")
    )
    return current, replaced


def new_dimension(batch: DataFrame, key_name: str, key: str, attributes: Sequence[str], updated: str, now: Column) -> DataFrame:
    """Type 2 initial load: every row current, effective on its update date."""
    rows = _opened(batch.withColumn("_effective", F.to_date(updated)), key, attributes, now)
    return _keyed(rows, key_name, key)


def _opened(rows: DataFrame, key: str, attributes: Sequence[str], now: Column, *extra: str) -> DataFrame:
    return rows.select(
        *extra,
        key,
        *attributes,
        F.col("_effective").alias("effective_date"),
        F.lit(HIGH_DATE).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
        now.alias("load_time"),
    )


def _keyed(rows: DataFrame, key_name: str, key: str, start: int | Column = 1) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    ordered = [key, "effective_date", *[c for c in others if c != "effective_date"]]
    return number_rows(rows, key_name, ordered, start).select(key_name, *rows.columns)


def _staged(dim: DataFrame, batch: DataFrame, key_name: str, key: str, attributes: Sequence[str], updated: str, null_safe: bool) -> DataFrame:
    """Batch rows beside the current version of their key, if there is one."""
    current = dim.filter("is_current").select(
        F.col(key).alias("_key"),
        F.col(key_name).alias("_existing"),
        F.col("effective_date").alias("_old_effective"),
        *[F.col(a).alias(f"_old_{a}") for a in attributes],
    )
    joined = batch.withColumn("_effective", F.to_date(updated)).join(
        current, F.col(key) == F.col("_key"), "left"
    )
    new = F.col("_existing").isNull()
    changed = any_difference(
        [F.col(f"_old_{a}") for a in attributes], [F.col(a) for a in attributes], null_safe
    )
    return joined.withColumn("_action", change_action(new, ~new & changed))


def late_rows(dim: DataFrame, batch: DataFrame, key_name: str, key: str, attributes: Sequence[str], updated: str) -> DataFrame:
    """Changes that are not newer than the current version they would replace."""
    staged = _staged(dim, batch, key_name, key, attributes, updated, False)
    late = (F.col("_action") == "UPDATE_EXISTING") & (F.col("_effective") <= F.col("_old_effective"))
    return staged.filter(late).select(*batch.columns)


def scd2_apply(
    dim: DataFrame, batch: DataFrame, key_name: str, key: str, attributes: Sequence[str],
    updated: str, now: Column, null_safe: bool = False, strict: bool = False,
) -> DataFrame:
    """Type 2 load: open new versions, then close what they replace.

    A new version opens for an unknown key or a changed attribute. A current row
    closes the day before the first newer version of its key opens; a version
    opened on the same day or earlier leaves it current (two current rows).
    ``strict`` refuses batches with repeated keys and leaves out late rows, so
    each key has one current row; see :func:`late_rows` for the rows left out.

    Closed history is passed through without a join or a shuffle.
    """
    if strict:
        repeated = batch.groupBy(key).count().filter("count > 1")
        if not repeated.isEmpty():
            raise DuplicateKeys(f"batch repeats values of {key!r}")

    staged = _staged(dim, batch, key_name, key, attributes, updated, null_safe)
    if strict:
        in_order = F.col("_existing").isNull() | (F.col("_effective") > F.col("_old_effective"))
        staged = staged.filter(in_order)
    opened = _opened(staged.filter("_action <> 'NO_CHANGE'"), key, attributes, now, "_action")
    last_key = dim.agg(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    versions = _keyed(opened, key_name, key, last_key + 1)

    # Distinct opening dates per key are bounded by the calendar, whatever the batch repeats.
    openings = (
        versions.filter("_action = 'UPDATE_EXISTING'")
        .groupBy(F.col(key).alias("_key"))
        .agg(F.collect_set("effective_date").alias("_dates"))
    )
    live = dim.filter("is_current").unionByName(versions.drop("_action"))
    joined = live.join(openings, F.col(key) == F.col("_key"), "left")
    next_open = F.array_min(F.filter("_dates", lambda d: d > F.col("effective_date")))
    closes = F.col("_next").isNotNull()
    settled = (
        joined.withColumn("_next", next_open)
        .withColumn("end_date", F.when(closes, F.date_sub("_next", 1)).otherwise(F.col("end_date")))
        .withColumn("is_current", ~closes)
        .withColumn("load_time", F.when(closes, now).otherwise(F.col("load_time")))
        .select(*dim.columns)
    )
    return dim.filter("NOT is_current").unionByName(settled)


def scd2_two_rows(
    dim: DataFrame, batch: DataFrame, key_name: str, key: str, attributes: Sequence[str], updated: str, now: Column,
) -> DataFrame:
    """The same load for batches without repeated keys, as two rows per change.

    Each change gives one row that closes the old version and one that opens the
    new one. Kept as an independent twin of :func:`scd2_apply`.
    """
    staged = _staged(dim, batch, key_name, key, attributes, updated, False)
    changes = staged.filter("_action = 'UPDATE_EXISTING' AND _old_effective < _effective")
    closing = changes.select(
        F.col("_existing").alias(key_name), F.date_sub("_effective", 1).alias("_closed_on")
    )
    expired = (
        dim.filter("is_current")
        .join(closing, key_name)
        .withColumn("end_date", F.col("_closed_on"))
        .withColumn("is_current", F.lit(False))
        .withColumn("load_time", now)
        .select(*dim.columns)
    )
    untouched = dim.join(closing, key_name, "left_anti").select(*dim.columns)
    last_key = dim.agg(F.coalesce(F.max(key_name), F.lit(0))).scalar()
    opened = _opened(staged.filter("_action <> 'NO_CHANGE'"), key, attributes, now)
    return union_sources([untouched, expired, _keyed(opened, key_name, key, last_key + 1)])


def scd6_view(dim: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Type 6: type 2 history with the current values beside every version.

    The current row is found per key by a pre-aggregated maximum and joined
    back, so no key's history is gathered in one window.
    """
    latest = (
        dim.filter("is_current")
        .groupBy(F.col(key).alias("_key"))
        .agg(
            F.max_by(
                F.struct(*[F.col(a).alias(f"current_{a}") for a in attributes]),
                F.struct("effective_date", *attributes),
            ).alias("_now")
        )
    )
    return dim.join(latest, F.col(key) == F.col("_key"), "left").select(*dim.columns, "_now.*")
