"""Quality rules with thresholds learnt from mergeable quantile sketches.

A sketch is a histogram with geometric buckets: a value keeps its leading
``SKETCH_BITS`` bits, so a bucket is at most 1/32 of its value wide and a sketch
has a few hundred buckets however many rows it counts. Two sketches merge by
adding counts, in any order and with equal results, so partial counts are summed
before the shuffle and the sketches of languages and of the corpus are made from
those of the sources.

Per language and source, a metric is an outlier when it lies beyond the quartiles
by ``reach`` times the larger of the quartile distance and a least spread. A group
of under ``min_rows`` rows takes its language's sketch, and a language that small
the corpus'. A group whose own median is an outlier of its language takes the
language's limits too, and so does one whose upper (for lower limits: lower) quartile
is beyond the language's limit on that side, so a source of junk does not set its own
standard.

Defined results: a null text has no words and fails the base rules; a null
language or source is a group of its own; repeated rows are judged alike; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import adjacent, present, shifted, text_or_empty, word_array
from tidemark.sources.scratch import written

SYMBOLS = "[#*$%&|<>]"
SKETCH_BITS = 6
WINDOW = 5
POSITION_BITS = 26


@dataclass(frozen=True)
class Limit:
    """How far beyond the quartiles a metric may lie; ``spread`` is in the metric's unit.

    ``few_words`` widens the limit by ``few_words / n_words``: means over few words vary more.
    """

    metric: str
    reach: int
    spread: int
    lower: bool = False
    few_words: int = 0


LIMITS = (
    Limit("symbols_per_1000_words", 3, 50),
    Limit("chars_per_100_words", 6, 40, lower=True, few_words=4000),
    Limit("dup_lines_per_1000", 3, 150),
)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines`` and ``n_repeat_words`` of each text."""
    value = text_or_empty(text)
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(value) - F.length(F.regexp_replace(value, SYMBOLS, ""))
    df = docs.withColumns({"_words": word_array(value), "_lines": lines, "n_symbols": symbols.cast("bigint")})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        }
    )
    return _with_repeated_words(df).drop("_words", "_lines")


def _with_repeated_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside windows of ``WINDOW`` words that the text holds twice or more.

    Each window becomes one long, the high bits of its hash above its position, so
    that one sort of plain longs puts equal windows side by side. Most texts have
    none and end there. For the others, whole 64-bit hashes are sorted as well: as
    many equal neighbours there prove that the high bits told all windows apart.
    Else structs of hash and position are sorted. Every step is linear or n log n.
    """
    length = F.size("_words") - (WINDOW - 1)
    zipped = F.arrays_zip(*[part.alias(f"w{i}") for i, part in enumerate(shifted(F.col("_words"), length, *range(WINDOW)))])
    digest = lambda g: F.xxhash64(*[g[f"w{i}"] for i in range(WINDOW)])
    low = F.lit((1 << POSITION_BITS) - 1)
    high = F.lit(-(1 << POSITION_BITS))
    equal = lambda a, b: a == b
    count = lambda flags: F.size(F.filter(flags, lambda x: x))

    df = df.withColumn("_grams", F.when(length > 0, zipped))
    packed = F.transform("_grams", lambda g, i: digest(g).bitwiseAND(high).bitwiseOR(i.cast("bigint")))
    df = df.withColumn("_packed", F.sort_array(packed))
    df = df.withColumn("_same", adjacent(F.col("_packed"), F.size("_packed"), lambda a, b: a.bitwiseAND(high) == b.bitwiseAND(high)))
    df = df.withColumn("_n_same", count(F.col("_same")))
    df = df.withColumn("_whole", F.when(F.col("_n_same") > 0, F.sort_array(F.transform("_grams", digest))))
    exact = count(adjacent(F.col("_whole"), F.size("_whole"), equal)) == F.col("_n_same")
    df = df.withColumn("_exact", (F.size("_grams") <= (1 << POSITION_BITS)) & exact)
    structs = F.sort_array(F.transform("_grams", lambda g, i: F.struct(digest(g).alias("h"), i.cast("bigint").alias("i"))))
    df = df.withColumn("_structs", F.when(~F.col("_exact"), structs))
    df = df.withColumns(
        {
            "_flags": F.when(F.col("_exact"), F.col("_same")).otherwise(
                adjacent(F.col("_structs"), F.size("_structs"), lambda a, b: a["h"] == b["h"])
            ),
            "_places": F.when(F.col("_exact") & (F.col("_n_same") > 0), F.transform("_packed", lambda x: x.bitwiseAND(low))).otherwise(
                F.transform("_structs", lambda x: x["i"])
            ),
        }
    )
    no = F.array(F.lit(False))
    repeated = F.zip_with(F.concat(no, "_flags"), F.concat("_flags", no), lambda a, b: a | b)
    starts = F.sort_array(present(F.zip_with(repeated, "_places", lambda yes, at: F.when(yes, at))))
    df = df.withColumn("_starts", F.when(F.col("_n_same") > 0, starts))
    # a window covers WINDOW words, or those up to the next repeated window
    after = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(F.lit(2**31).cast("bigint")))
    covered = F.aggregate(
        F.zip_with("_starts", after, lambda a, b: F.least(F.lit(WINDOW).cast("bigint"), b - a)),
        F.lit(0).cast("bigint"), lambda total, x: total + x,
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop(
        "_grams", "_packed", "_same", "_n_same", "_whole", "_exact", "_structs", "_flags", "_places", "_starts"
    )


def metrics() -> dict[str, Column]:
    """Whole-number metrics, so that every engine puts them into the same bucket."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_1000_words": (F.col("n_symbols") * 1000 / words).cast("bigint"),
        "chars_per_100_words": (F.col("word_chars") * 100 / words).cast("bigint"),
        "dup_lines_per_1000": (F.col("n_dup_lines") * 1000 / lines).cast("bigint"),
    }


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: its leading ``SKETCH_BITS`` bits."""
    low_bits = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low_bits), low_bits)


def sketches(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """Counts by group, metric and bucket."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in values]))
    return (
        df.select(*groups, pairs.alias("_pair"))
        .groupBy(*groups, F.col("_pair.metric").alias("metric"), F.col("_pair.bucket").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, groups: list[str]) -> DataFrame:
    return sketch.groupBy(*groups, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """``n``, ``q25``, ``q50`` and ``q75`` of each group and metric."""
    group = Window.partitionBy(*groups, "metric")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(group)})
    at = lambda p: F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, F.col("bucket")))
    return ranked.groupBy(*groups, "metric").agg(
        F.max("_all").alias("n"), at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75")
    )


def thresholds(sketch: DataFrame, lang: str, source: str, limits=LIMITS, min_rows: int = 200) -> DataFrame:
    """One row of limits per language and source: ``<metric>_hi`` and, where asked for, ``<metric>_lo``."""
    constants = F.create_map(*[F.lit(x) for m in limits for x in (m.metric, m.reach)])
    spreads = F.create_map(*[F.lit(x) for m in limits for x in (m.metric, m.spread)])

    def fences(groups: list[str], prefix: str) -> DataFrame:
        q = quartiles(merged(sketch, groups), groups)
        room = constants[F.col("metric")] * F.greatest(F.col("q75") - F.col("q25"), spreads[F.col("metric")])
        return q.select(
            *groups, "metric", F.col("n").alias(f"{prefix}_n"), F.col("q50").alias(f"{prefix}_mid"),
            F.col("q75").alias(f"{prefix}_q_hi"), F.col("q25").alias(f"{prefix}_q_lo"),
            (F.col("q75") + room).alias(f"{prefix}_hi"), (F.col("q25") - room).alias(f"{prefix}_lo"),
        )

    own, by_lang, corpus = fences([lang, source], "own"), fences([lang], "lang"), fences([], "all")
    far = by_lang.withColumnsRenamed({lang: "_far_lang", "metric": "_metric"})
    all_rows = corpus.withColumnRenamed("metric", "_corpus_metric")
    joined = own.join(far, F.col(lang).eqNullSafe(F.col("_far_lang")) & (F.col("metric") == F.col("_metric"))).join(
        all_rows, F.col("metric") == F.col("_corpus_metric")
    )
    few_lang, few_own = F.col("lang_n") < min_rows, F.col("own_n") < min_rows
    wide = {}
    for side in ("hi", "lo"):
        wide[f"_{side}_lang"] = F.when(few_lang, F.col(f"all_{side}")).otherwise(F.col(f"lang_{side}"))
    joined = joined.withColumns(wide)
    odd = (F.col("own_mid") > F.col("_hi_lang")) | (F.col("own_mid") < F.col("_lo_lang"))
    beyond = {"hi": F.col("own_q_hi") > F.col("_hi_lang"), "lo": F.col("own_q_lo") < F.col("_lo_lang")}
    for side in ("hi", "lo"):
        joined = joined.withColumn(f"_{side}", F.when(few_own | odd | beyond[side], F.col(f"_{side}_lang")).otherwise(F.col(f"own_{side}")))
    columns = []
    for m in limits:
        for side in ("hi", "lo") if m.lower else ("hi",):
            columns.append(F.max(F.when(F.col("metric") == m.metric, F.col(f"_{side}"))).alias(f"{m.metric}_{side}"))
    return joined.groupBy(lang, source).agg(*columns)


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", limits=LIMITS,
    min_rows: int = 200, least_words: int = 10, repeat_percent: int = 20, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) with counts, ``base_failed`` and ``kept``.

    The sketches cover every document of at least ``least_words`` words. Counts
    and limits are written once to the shared folder: texts are read once, and the
    size of the limits tells Spark whether to broadcast them or to join by
    shuffle, where it splits a hot source.
    """
    keep = docs.columns if keep is None else keep
    values = [m.metric for m in limits]
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.col(source).alias("_source"))
    counted = written(with_counts(packed, "_text").drop("_text").withColumns({m: metrics()[m] for m in values}), "counts")
    sketch = written(sketches(counted.filter(F.col("n_words") >= least_words), ["_lang", "_source"], values), "sketches")
    own_limits = thresholds(sketch, "_lang", "_source", limits, min_rows)
    limit_rows = written(own_limits.withColumnsRenamed({"_lang": "_of_lang", "_source": "_of_source"}), "limits")
    judged = counted.join(
        limit_rows, F.col("_lang").eqNullSafe(F.col("_of_lang")) & F.col("_source").eqNullSafe(F.col("_of_source")), "left"
    )
    beyond = []
    for m in limits:
        room = (F.lit(m.few_words) / F.greatest("n_words", F.lit(1))).cast("bigint")
        beyond.append(F.col(m.metric) > F.col(f"{m.metric}_hi") + room)
        if m.lower:
            beyond.append(F.col(m.metric) < F.col(f"{m.metric}_lo") - room)
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
    outlier = F.coalesce(reduce(Column.__or__, beyond), F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("_row", *counts, failed.alias("base_failed"), (~failed & ~outlier).alias("kept"))
