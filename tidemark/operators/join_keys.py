"""Join keys found from names and from the values behind them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, MapType, StructType

KEYS = "child_table string, child_column string, parent_table string, parent_column string"
_RANGE = 1 << 32


def inferred_keys(
    tables: Mapping[str, DataFrame], named: Callable[[str], str], sample: int = 4096, least: float = 0.95,
) -> DataFrame:
    """Columns of one table whose values are keys of another, as one row per pair of columns.

    Columns pair up if ``named`` gives them one name and their types fit. The
    parent column must tell rows apart: its distinct values, estimated to one
    per cent, are ``least`` of its rows. Then about ``sample`` distinct values
    of the child column, those under a hash bound that its own number of
    distinct values sets, are looked up among all values of the parent under
    that bound; ``least`` of them must be there. The bound makes both sides show
    the same values, so the sample is as small for a table of any size and each
    sampled value is truly looked up. Two scans per table; a repeated value is
    folded before the shuffle. NULL is no value; a column without values is no
    child. Counts per column, one row a table, reach the driver.
    """
    columns = [(t, f.name, _kind(f.dataType)) for t, df in tables.items() for f in df.schema if _kind(f.dataType)]
    pairs = [
        (a, b) for a in columns for b in columns
        if a[0] != b[0] and a[2] == b[2] and named(a[1]) == named(b[1])
    ]
    counts = {t: _counts(tables[t], sorted({c[1] for p in pairs for c in p if c[0] == t})) for t in {c[0] for p in pairs for c in p}}
    shares = {
        (child[:2], parent[:2]): min(1.0, sample / counts[child[0]][child[1]])
        for child, parent in pairs
        if counts[child[0]][child[1]] and counts[parent[0]][parent[1]] >= least * counts[parent[0]][None]
    }
    spark = next(iter(tables.values())).sparkSession
    keys = [(*child, *parent) for child, parent in shares]
    if not keys:
        return spark.createDataFrame([], KEYS)

    looked_at: dict[str, list] = {}
    for pair, ((child, parent), share) in enumerate(shares.items()):
        for (table, name), is_child in ((child, True), (parent, False)):
            text = F.col(f"`{name}`").cast("string")
            chosen = F.pmod(F.xxhash64(text), F.lit(_RANGE)) < int(share * _RANGE)
            seen = F.struct(F.lit(pair).alias("pair"), text.alias("value"), F.lit(is_child).alias("child"), F.lit(not is_child).alias("parent"))
            looked_at.setdefault(table, []).append(F.when(text.isNotNull() & chosen, seen))
    seen = [tables[t].select(F.explode(F.array_compact(F.array(*parts))).alias("s")).select("s.*") for t, parts in looked_at.items()]
    values = reduce(DataFrame.unionByName, seen).groupBy("pair", "value").agg(F.max("child").alias("child"), F.max("parent").alias("parent"))
    found = values.filter("child").groupBy("pair").agg(F.avg(F.col("parent").cast("int")).alias("share")).filter(F.col("share") >= least)
    names = spark.createDataFrame([(i, *key) for i, key in enumerate(keys)], f"pair int, {KEYS}")
    return names.join(found, "pair").drop("pair", "share")


def _kind(kind: DataType) -> str | None:
    if isinstance(kind, ArrayType | MapType | StructType):
        return None
    return "whole number" if isinstance(kind, IntegralType) else kind.simpleString()


def _counts(df: DataFrame, names: list[str]) -> dict[str | None, int]:
    """Rows under None, distinct values per column."""
    row = df.agg(F.count("*"), *[F.approx_count_distinct(f"`{n}`", 0.01) for n in names]).first()
    return dict(zip([None, *names], row))
