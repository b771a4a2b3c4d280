"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link each neighbour (the larger ones, or those not larger and the node itself) to the least of them.

    The least neighbour is an aggregate that is summed up before the shuffle, and
    comes back by a join that Spark splits where a node has very many neighbours.
    """
    both = pairs.union(pairs.select("b", "a")).toDF("u", "v") if larger else pairs.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("of"))
    if larger:
        out = joined.filter(F.col("v") > F.col("u")).select("v", "m")
    else:
        out = joined.select("v", "m").union(least.select("of", "m"))
    return out.toDF("a", "b").filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its least reachable node) for every node of ``links``.

    Each round is written to the shared folder, which cuts the lineage and
    survives lost executors. The driver sees two numbers per round. Self links
    and repeated links change nothing; links with a null end are ignored; no
    links give no rows.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    pairs = written(ends.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        pairs = written(_stars(_stars(pairs, larger=True), larger=False), "stars")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    alone = ends.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return found.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))
