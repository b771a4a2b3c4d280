"""Mix sources to target weights by hash-random order and exact budgets.

Each source's budget comes from its weight, stopped at ``most_epochs`` times its
size; what it can't use is shared out again by weight until no source is above.
Whole epochs take every document that often. For the rest, documents of a source
stand in the order of a hash key. The key's high bits are a range: range totals,
summed before the shuffle, give each range the words before it, so only the one
range in which the budget ends has to be sorted. A source with a third of all rows
is spread over ``1 << RANGE_BITS`` ranges.

The document at the budget's end is taken if that comes nearer to the budget than
leaving it, so documents stay whole and a source misses its budget by half a
document at most. Keys depend on the id and the text alone: reruns agree.

Defined results: a null text has size 0 and is taken 0 words; a null source is a
source of its own, after all others; repeated rows count each; a null id is
ordered by its text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import SPACE_RUN, text_or_empty
from tidemark.operators.ordering import number_rows
from tidemark.sources.scratch import written

RANGE_BITS = 12
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, SPACE_RUN), "")).cast("bigint")


def random_key(*columns: str) -> Column:
    """``KEY_BITS`` bits of an MD5 over the columns, the same in every run and engine."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\n", *parts)), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most_epochs: int = 3) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``source_size``.

    Weights repeat over the sources in code point order, null last. Each round
    stops the sources that are above and shares the rest anew; only three numbers
    a round reach the driver. Sources without words get 0.
    """
    ranked = number_rows(sizes.withColumn("_null", F.col("source").isNull()), "_rank", ["_null", "source"], start=0)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("_rank", F.lit(len(weights))).cast("int"))
    table = written(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * most_epochs).alias("cap")), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        above = F.col("cap") < level * F.col("w")
        n, spent, open_weight = table.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.sum(F.when(~above, F.col("w")).otherwise(0.0)),
        ).first()
        if n == stopped or not open_weight:
            break
        stopped, level = n, (total - spent) / open_weight
    return table.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("w")).alias("target"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), most_epochs: int = 3, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns as a struct ``_row`` with ``size``, ``source_size``, ``target`` and ``times`` (how often taken).

    What is taken once more than the whole epochs ends, per source, at one key and
    id. So documents meet a table of one row per source, whose size tells Spark
    whether to broadcast it or to join by shuffle, where it splits a large source.
    Sizes and keys are cheaper to work out twice than to write with the texts.
    """
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(source).alias("source"))
    rows = rows.withColumns({"size": word_count(text_or_empty("_text")), "_key": random_key("_id", "_text")})
    rows = rows.withColumn("_range", F.shiftright("_key", KEY_BITS - RANGE_BITS).cast("int")).drop("_text")
    sized = written(rows.select("source", "size", "_key", "_id", "_range"), "sizes")

    ranges = written(sized.groupBy("source", "_range").agg(F.sum("size").alias("_words")), "ranges")
    budget = targets(ranges.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, most_epochs)
    budget = budget.withColumn("_epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("bigint"))
    budget = budget.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")).withColumnRenamed("source", "_of")
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).join(
        budget, F.col("source").eqNullSafe(F.col("_of"))
    )
    ends = (F.col("_rest") > 0) & (F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest"))
    last = written(
        placed.filter(ends).select(F.col("source").alias("_source"), F.col("_range").alias("_end"), "_before", "_rest"), "last-ranges"
    )

    # inside the last range of each source, rows of one key and id stand together
    inside = sized.join(last, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_end")))
    units = inside.groupBy("source", "_key", "_id").agg(
        F.sum("size").alias("_size"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest")
    )
    upto = Window.partitionBy("source").orderBy("_key", "_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_size").over(upto), F.lit(0))
    taken = units.withColumn("_nearer", start + F.col("_size") / 2 <= F.col("_rest")).filter("_nearer")
    cut = taken.groupBy("source").agg(F.max(F.struct("_key", "_id")).alias("_cut")).withColumnRenamed("source", "_cut_of")
    limits = budget.select("_of", "source_size", "target", "_epochs")
    limits = limits.join(last.select("_source", "_end"), F.col("_of").eqNullSafe(F.col("_source")), "left")
    limits = written(limits.join(cut, F.col("_of").eqNullSafe(F.col("_cut_of")), "left").drop("_source", "_cut_of"), "cuts")

    joined = rows.join(limits, F.col("source").eqNullSafe(F.col("_of")))
    once_more = F.coalesce(
        (F.col("_range") < F.col("_end")) | ((F.col("_range") == F.col("_end")) & (F.struct("_key", "_id") <= F.col("_cut"))), F.lit(False)
    )
    return joined.select("_row", "size", "source_size", "target", (F.col("_epochs") + once_more.cast("bigint")).alias("times"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it."""
    taken = mix(docs, **options).filter("times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("_time")).select("_row.*")
