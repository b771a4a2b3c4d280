"""Joins. Spark picks the strategy from measured sizes; only literals are hinted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import CAMPAIGNS
from tidemark.sources.scratch import written

JOIN_TYPES = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "FULL": "full"}


def join_by_name(left: DataFrame, right: DataFrame, on: Column | Sequence[str], kind: str) -> DataFrame:
    """Join whose type is a parameter: INNER, LEFT, RIGHT or FULL."""
    return left.join(right, on if isinstance(on, Column) else list(on), JOIN_TYPES[kind.upper()])


def campaign_lookup(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame(CAMPAIGNS, "traffic_source string, campaign_type string")


def enrich_campaign(df: DataFrame) -> DataFrame:
    """Left join to the four-row campaign relation; unknown sources keep NULL."""
    return df.join(F.broadcast(campaign_lookup(df)), "traffic_source", "left")


def as_of(facts: DataFrame, versions: DataFrame, key: str, fact_date: str) -> DataFrame:
    """Attach to each fact the dimension version valid on its date.

    The equality on the key keeps this a hash or sort-merge join. Facts without
    a valid version survive with NULL attributes.
    """
    v = versions.withColumnRenamed(key, "_key")
    valid = F.col(fact_date).between(F.col("effective_date"), F.col("end_date"))
    return facts.join(v, (F.col(key) == F.col("_key")) & valid, "left").drop("_key")


def as_of_carried(
    facts: DataFrame, versions: DataFrame, key: str, fact_date: str, spread: Sequence[str],
    newest: Sequence[str] = ("effective_date", "end_date"), grain: str = "month", most: int = 1_000_000,
) -> DataFrame:
    """:func:`as_of` by one sort, for keys with many versions: facts and versions never meet in pairs.

    Facts and versions of a key are sorted together by date, and the last
    version is carried forward. The rows of a key are cut into steps of
    ``grain``; each step starts with the version in force before it, found on
    one row per key and step. A step with over ``most`` facts is dealt by a hash
    of their ``spread`` columns, which should tell facts apart, and each share
    gets the step's versions.

    Where versions of a key do not overlap, the result is that of ``as_of``.
    Where they do, a fact gets one version: the last to start, of equal starts
    the largest by ``newest``. Versions that end before they start, or lack a
    key or a date, match nothing; facts without a key, a date or a valid version
    survive with NULL attributes.
    """
    attributes = [c for c in versions.columns if c != key]
    step = F.date_trunc(grain, "_at").alias("_step")
    all_facts = facts.select(F.struct(*facts.columns).alias("_fact"), F.col(key).alias("_key"), F.col(fact_date).alias("_at"))
    dated = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    known = all_facts.filter(dated).select("*", step)
    valid = versions.filter(F.col(key).isNotNull() & (F.col("end_date") >= F.col("effective_date")))
    starts = valid.select(
        F.col(key).alias("_key"), F.col("effective_date").alias("_at"),
        F.struct(*attributes).alias("_version"), F.struct(*newest).alias("_newest"),
    ).select("*", step)

    both = known.select("_key", "_step", F.lit(1).alias("_one")).unionByName(starts.drop("_at"), allowMissingColumns=True)
    steps = both.groupBy("_key", "_step").agg(F.count("_one").alias("_n"), F.max_by("_version", "_newest").alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    seeds = steps.select("_key", "_step", "_n", F.last("_last", True).over(earlier).alias("_version"))
    shares = F.ceil(F.col("_n") / most).cast("int").alias("_shares")
    seeds = written(seeds.filter("_n > 0").select("_key", "_step", "_version", shares), "as_of")

    hot = seeds.filter("_shares > 1").select("_key", "_step", "_shares")
    shared = lambda df: df.join(hot, ["_key", "_step"], "left").withColumn("_shares", F.coalesce("_shares", F.lit(1)))
    each = F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))
    dealt = F.pmod(F.xxhash64(*[F.col("_fact")[c] for c in spread]), F.col("_shares")).cast("int")
    rows = (
        shared(known).withColumns({"_share": dealt, "_kind": F.lit(1)})
        .unionByName(shared(starts).withColumns({"_share": each, "_kind": F.lit(0)}), allowMissingColumns=True)
        .unionByName(seeds.filter("_version IS NOT NULL").withColumns({"_share": each, "_kind": F.lit(0)}), allowMissingColumns=True)
    )
    so_far = (
        Window.partitionBy("_key", "_step", "_share").orderBy("_at", "_kind", "_newest")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = rows.withColumn("_version", F.last("_version", True).over(so_far)).filter("_kind = 1")
    in_force = F.when(F.col("_version.end_date") >= F.col("_at"), F.col("_version"))
    found = carried.select("_fact", in_force.alias("_version")).unionByName(
        all_facts.filter(~dated).select("_fact"), allowMissingColumns=True
    )
    return found.select("_fact.*", *[F.col("_version")[c].alias(c) for c in attributes])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent, F.col(child_key) == F.col(parent_key), "left_anti")


def matched(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent, F.col(child_key) == F.col(parent_key), "left_semi")
