"""Positions in a total order and running totals, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.columns import column
from tidemark.sources.scratch import written

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits
_BINS = 1 << 16


def number_rows(
    df: DataFrame, out: str, order_by: Sequence[str] | None = None, start: int | Column = 1,
) -> DataFrame:
    """Dense consecutive numbers from ``start``, in ``order_by`` order.

    Rows are range-partitioned and sorted, numbered inside their partition, and
    shifted by the row counts of the partitions before. Those counts, one per
    partition, reach the rows as a scalar subquery, so the result keeps the size
    statistics of a plain scan for the joins that follow. Give a unique
    ``order_by``, so that equal keys do not pile up in one range. Without
    ``order_by`` rows are numbered where they are, which needs no shuffle at all.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    numbered = written(df.withColumn("_at", F.monotonically_increasing_id()), "positions")
    numbered = numbered.withColumn("_part", F.shiftright("_at", _LOCAL_BITS))

    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    by_part = shifts.agg(
        F.map_from_entries(F.collect_list(F.struct("_part", "_shift"))).alias("shift_of"),
        F.max("_part").alias("last"),
    ).select(F.transform(F.sequence(F.lit(0).cast("bigint"), "last"), lambda p: F.col("shift_of")[p]))

    first = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    shift = F.get(by_part.scalar(), F.col("_part").cast("int"))
    return numbered.withColumn(out, (shift + local + first).cast("bigint")).drop("_part", "_at")


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """Median of a whole column as a one-row frame, found by counting: no sort, no copy.

    A first pass counts values by 64 logarithmic bins for each power of two, so
    that outliers cost nothing; each later pass splits the bin of the middle
    into 65,536 of equal width. A pass narrows the values by its bins, so two or
    three scans do, and a value that holds most rows ends it at once. Only the
    bin of the middle, two at most, reaches the driver. NULL is left out, NaN is
    the largest value, and without any value the median is NULL. ``df`` is read
    once per pass: write it first where that is dear.
    """
    rows = df.select(F.col(value).alias("v")).filter(F.col("v").isNotNull())
    one, other = _middle(rows)
    schema = StructType([StructField(value, df.schema[value].dataType)])
    return df.sparkSession.createDataFrame([(one,), (other,)], schema).agg(F.avg(value).alias("median"))


def _middle(rows: DataFrame) -> tuple:
    """The two middle values of ``v``: one value twice where their number is odd."""
    ranks, passed, part, bin_of = None, 0, rows, _log_bin(F.col("v").cast("double"))
    while True:
        bins = part.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        counted = bins.select("*", F.sum("n").over(Window.orderBy("bin")).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
        first, second = [F.lit(r - passed) for r in ranks] if ranks else [F.floor((F.col("all") + i) / 2) for i in (1, 2)]
        holds = lambda rank: (rank > F.col("upto") - F.col("n")) & (rank <= F.col("upto"))
        found = counted.filter(holds(first) | holds(second)).orderBy("bin").collect()
        if not found:
            return None, None
        if len(found) == 2:  # neighbours in different bins
            return found[0]["high"], found[1]["low"]
        at = found[0]
        low, high = at["low"], at["high"]
        if low == high or low != low:
            return low, low
        ranks = ranks or [(at["all"] + 1) // 2, (at["all"] + 2) // 2]
        passed += at["upto"] - at["n"]
        part = rows.filter(F.col("v").between(F.lit(low), F.lit(high)))
        away = lambda x: (x - F.lit(low)).cast("double")
        bin_of = F.floor(away(F.col("v")) / away(F.lit(high)) * _BINS)


def _log_bin(x: Column) -> Column:
    """Number that rises with a double: 64 steps per power of two on both sides of zero; NaN last."""
    steps = F.floor(F.least(F.log2(F.abs(x)), F.lit(1100.0)) * 64) + 1075 * 64 + 1
    signed = F.when(x > 0, steps).when(x < 0, -steps).otherwise(0)
    return F.when(F.isnan(x), 1 << 20).otherwise(signed)


def running_total(
    df: DataFrame, keys: Sequence[str], levels: Sequence[tuple[str, Column]],
    order_by: Sequence[Column | str], value: Column, out: str,
) -> DataFrame:
    """Running sum per key that never sorts one whole key in one task.

    ``levels`` are named steps that rise with the order, coarse first, such as
    the day and then a block of a sequence number. The sum of all earlier steps
    is computed on pre-aggregated rows and enters each step as a first row, so
    only the rows inside one step are sorted together. Exact for any key
    distribution, NULL keys and values included.
    """
    return _running(df, keys, levels, order_by, value, out, Window.currentRow)


def _running(
    df: DataFrame, keys: Sequence[str], levels: Sequence[tuple[str, Column]],
    order_by: Sequence[Column | str], value: Column, out: str, last: int,
) -> DataFrame:
    rows = df.withColumns({"_value": value, "_row": F.lit(True), **dict(levels)})
    groups = [*keys, *[name for name, _ in levels]]
    if levels:
        steps = rows.groupBy(*groups).agg(F.sum("_value").alias("_sum"))
        outer = [(name, F.col(name)) for name, _ in levels[:-1]]
        earlier = _running(steps, keys, outer, [levels[-1][0]], F.col("_sum"), "_before", -1)
        seeds = earlier.select(*groups, F.col("_before").alias("_value"), F.lit(False).alias("_row"))
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    inside = (
        (Window.partitionBy(*groups) if groups else Window)
        .orderBy("_row", *order_by)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        rows.withColumn(out, F.sum("_value").over(inside))
        .filter("_row")
        .select(*df.columns, out)
    )


def sequence_block(sequence: Column | str, size: int = 1_000_000) -> Column:
    """Step for :func:`running_total`: at most ``size`` values of a unique sequence each."""
    return F.floor(column(sequence) / F.lit(size)).cast("bigint")
