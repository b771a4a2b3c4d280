"""URL filter: allow and block rules, and for the rest a character language-model ratio.

A rule names a host and a start of the path, fits that host and its subdomains,
and the longest that fits decides. The URLs that rules accept and those that they
reject train two smoothed Markov models of variable order over the characters of
host and path: a context of up to ``ORDER`` characters is used as far as it was
seen, and each order is interpolated with the next lower one by Witten and Bell.
A URL that no rule fits is accepted if its log-likelihood difference per character
reaches a limit, which is calibrated on the URLs that rules decided: the one with
the least sum of both error rates.

Counts cover every URL. Each different host and path is exploded into its n-grams
once and counted as often as it is there; counts are summed before the shuffle.
The model is a table of all n-grams that were seen, so it grows with the corpus. An
n-gram's row holds by how much its log difference exceeds that of the n-gram
without its first character. What ends a seen n-gram was seen as well, so the rows
that fit at one place add up to the log difference of the longest one: scoring
joins n-grams with the model and sums up by URL. Differences are whole numbers of
``1 / UNITS``, so any order of the sum gives the same score.

Everything is DataFrame code. Defined results: a null URL, or one without ``://``,
has an empty host and path and is judged by the model like any other; without any
accepted or any rejected URL, the model accepts; an empty table gives an empty
result.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

ORDER = 4
#: A log difference of 1 in the model.
UNITS = 1_000_000_000
#: Log differences per character in the calibration: bins of 1 / BINS from -LIMIT to LIMIT.
BINS, LIMIT = 100, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text) if text is None else text.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    return (F.lit(None).cast("string"),) * 2 if text is None else (text, verdict)


def _contexts(value: Column) -> list[Column]:
    """For each order, an array with one n-gram per character and the end: that many characters before it, and itself.

    The arrays are shifted against one another, so no lambda looks into an array.
    """
    chars = F.concat(F.array_remove(F.split(value, ""), ""), F.array(F.lit("\u0003")))
    size = F.size(chars)
    out = [chars]
    for order in range(1, ORDER + 1):
        head = F.array(*[F.lit("\u0002")] * order)
        before = F.slice(F.concat(head, chars), F.lit(1), size)
        out.append(F.zip_with(before, out[-1], lambda a, b: F.concat(a, b)))
    return out


def _witten_bell(counts: DataFrame, n: str) -> DataFrame:
    """``gram`` and the probability ``p`` of its last character after the others, under the counts in column ``n``."""
    lowest = None
    for order in range(ORDER + 1):
        grams = counts.filter(F.col("order") == order).select("gram", n)
        context, rest = F.substring("gram", 1, order), F.substring(F.col("gram"), 2, ORDER + 1)
        if order == 0:
            all_rows = grams.agg(F.sum(n).alias("_all"), F.count_if(F.col(n) > 0).alias("_kinds"), F.count("*").alias("_chars"))
            total, kinds, chars = (all_rows.select(c).scalar() for c in ("_all", "_kinds", "_chars"))
            p = (F.col(n) + kinds / chars) / (total + kinds)
            lowest = grams.select("gram", F.coalesce(p, 1 / chars).alias("p"))
            result = lowest.withColumn("order", F.lit(0))
        else:
            seen = grams.groupBy(context.alias("_context")).agg(F.sum(n).alias("_all"), F.count_if(F.col(n) > 0).alias("_kinds"))
            joined = grams.withColumns({"_of": context, "_rest": rest}).join(seen, F.col("_of") == F.col("_context"))
            joined = joined.join(lowest.select(F.col("gram").alias("_lower"), F.col("p").alias("_q")), F.col("_rest") == F.col("_lower"))
            p = F.when(F.col("_all") == 0, F.col("_q")).otherwise((F.col(n) + F.col("_kinds") * F.col("_q")) / (F.col("_all") + F.col("_kinds")))
            lowest = written(joined.select("gram", p.alias("p")), "orders")
            result = result.unionByName(lowest.withColumn("order", F.lit(order)))
    return result


def _grams(value: Column) -> Column:
    """All n-grams of a value in one array; the order of each is its length less one."""
    return F.concat(*_contexts(value))


def fit(urls: DataFrame, value: str, accepted: str, times: str | None = None) -> DataFrame:
    """``order``, ``gram``, its log difference ``units`` and what it adds to that of the next shorter one, ``gain``.

    ``accepted`` is true, false, or null for a URL that trains neither model;
    ``times`` says how often each row counts.
    """
    n = F.lit(1).cast("bigint") if times is None else F.col(times)
    rows = urls.filter(F.col(accepted).isNotNull()).select(
        F.col(accepted).alias("_accepted"), n.alias("_times"), F.explode(_grams(F.col(value))).alias("gram")
    )
    count = lambda which: F.sum(F.when(which, F.col("_times")).otherwise(0))
    counts = written(
        rows.groupBy("gram").agg(count(F.col("_accepted")).alias("yes"), count(~F.col("_accepted")).alias("no"))
        .select((F.length("gram") - 1).alias("order"), "gram", "yes", "no"), "grams"
    )
    yes = _witten_bell(counts, "yes").select(F.col("order"), F.col("gram"), F.col("p").alias("_yes"))
    no = _witten_bell(counts, "no").select(F.col("gram").alias("_h"), F.col("p").alias("_no"))
    units = F.round(F.log(F.col("_yes") / F.col("_no")) * UNITS).cast("bigint")
    ratios = written(yes.join(no, F.col("gram") == F.col("_h")).select("order", "gram", units.alias("units")), "ratios")
    shorter = ratios.filter(F.col("order") < ORDER).select(F.col("gram").alias("_shorter"), F.col("units").alias("_below"))
    joined = ratios.join(shorter, (F.col("order") > 0) & (F.substring(F.col("gram"), 2, ORDER) == F.col("_shorter")), "left")
    return written(joined.select("order", "gram", "units", (F.col("units") - F.coalesce("_below", F.lit(0))).alias("gain")), "model")


def scores(values: DataFrame, value: str, key: str, model: DataFrame) -> DataFrame:
    """``values`` with ``log_ratio``: mean log difference per character, by the longest context that the model knows.

    ``key`` is different for each row. An n-gram that the model lacks adds nothing.
    """
    grams = values.select(F.col(key).alias("_of"), F.explode(_grams(F.col(value))).alias("_gram"))
    known = model.select("gram", "gain")
    sums = grams.join(known, F.col("_gram") == F.col("gram")).groupBy("_of").agg(F.sum("gain").alias("_sum"))
    mean = F.coalesce("_sum", F.lit(0)) / UNITS / F.size(_contexts(F.col(value))[0])
    return values.join(sums, F.col(key) == F.col("_of"), "left").withColumn("log_ratio", mean).drop("_of", "_sum")


def score(value: Column, model: DataFrame) -> Column:
    """``scores`` as an expression, which holds the whole model as a constant: for small models only."""
    known = F.from_json(F.lit(json.dumps({r.gram: r.gain for r in model.select("gram", "gain").collect()})), "map<string,bigint>")
    total = F.aggregate(_grams(value), F.lit(0).cast("bigint"), lambda total, gram: total + F.coalesce(known[gram], F.lit(0)))
    return total / UNITS / F.size(_contexts(value)[0])


def calibrate(scored: DataFrame, column: str, accepted: str, times: str) -> float:
    """The limit with the least sum of the shares of accepted URLs below and rejected ones above it.

    Each row counts ``times`` times. Scores are counted in bins, of which there is a
    fixed number. Of equal limits the lowest is taken, in the middle of the empty bins
    below it: a URL that trained neither model scores nearer to zero than those that did.
    """
    clipped = F.greatest(F.lit(-LIMIT * BINS), F.least(F.lit(LIMIT * BINS), F.floor(F.col(column) * BINS))).cast("int")
    bins = scored.filter(F.col(accepted).isNotNull()).groupBy(clipped.alias("bin")).agg(
        F.sum(F.when(F.col(accepted), F.col(times)).otherwise(0)).alias("yes"),
        F.sum(F.when(~F.col(accepted), F.col(times)).otherwise(0)).alias("no"),
    )
    rows = sorted(bins.collect())  # at most 2 * LIMIT * BINS + 1
    yes, no = sum(r.yes for r in rows), sum(r.no for r in rows)
    if not yes or not no:
        return float("-inf")
    best, limit, below_yes, below_no, free = 2.0, -float(LIMIT), 0, 0, rows[0].bin
    for row in rows:
        error = below_yes / yes + (no - below_no) / no
        if error < best:
            best, limit = error, (free + row.bin) / 2 / BINS
        free = row.bin + 1
        below_yes, below_no = below_yes + row.yes, below_no + row.no
    return limit


def judge(pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns as a struct ``_row`` with ``host``, ``path``, ``rule``, ``verdict`` and ``log_ratio``."""
    keep = pages.columns if keep is None else keep
    df = pages.select(F.struct(*keep).alias("_row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    df = df.withColumns({"rule": rule, "_ruled": verdict, "_value": F.concat("host", "path")})
    # host and path, and so the verdict of a rule, follow from their concatenation: a host holds no "/", a path starts with one
    values = df.groupBy("_value", (F.col("_ruled") == "allow").alias("_accepted")).agg(F.count("*").alias("_times"))
    values = written(values.withColumn("_key", F.monotonically_increasing_id()), "values")
    model = fit(values, "_value", "_accepted", "_times")
    scored = written(scores(values, "_value", "_key", model).withColumnRenamed("_value", "_scored"), "scores")
    limit = calibrate(scored, "log_ratio", "_accepted", "_times")
    by_model = F.when(F.col("log_ratio") >= limit, "allow").otherwise("block")
    joined = df.join(scored.select("_scored", "log_ratio"), F.col("_value") == F.col("_scored"))
    return joined.select("_row", "host", "path", "rule", F.coalesce("_ruled", by_model).alias("verdict"), "log_ratio")
