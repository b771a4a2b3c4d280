"""License scans: exact phrases, and an exact set-similarity join of text blocks with templates.

Words are runs of letters a-z, digits and characters beyond ASCII, after A-Z are
lower-cased. A text's blocks are windows of ``2 * span`` words that start every
``span`` words, where ``span`` is the length of the longest template: each passage that
long lies whole in one block, wherever lines break. A template is found in a block that
holds at least ``share`` of its different tokens (containment). All such pairs of block
and template are found, and no others, by the filters of set-similarity joins:

- *Order.* Tokens stand in one global order, the rarest of the corpus first.
- *Prefix.* A template of ``n`` tokens needs ``need = ceil(share * n)`` of them, so one of
  its first ``n - need + 1`` is in the block; and one of the block's first
  ``m - need + 1``, if ``m`` of its tokens occur in any template. Both prefixes share a
  token. Blocks without one are dropped before anything is exploded.
- *Length.* ``m`` is at least ``need``.
- *Position.* From a shared prefix token on, both sides have enough tokens left.

Tokens in no template can't count, so they never leave the scan. The rest is a join of
token rows with the prefix table, a count of common tokens for what is left, and one
aggregate per different text. Templates are a parameter, a few dozen short notices.
Everything else covers all documents and whole texts; texts are read twice.

Defined results: a null text is empty, has no words and no labels; repeated rows and
equal texts get equal results; an empty table gives an empty result; a text shorter than
a block is one block; ``score`` is 1 with a phrase, else the largest containment found, else 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212a"  # the one character beyond ASCII whose lower case is a lone ASCII letter

# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.text.split()))


# Openings of public license notices, in plain words.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("creative-commons", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def lowered(text: Column) -> Column:
    """Lower case in which exactly A-Z become ASCII letters."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("\u00e7")))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), NO_WORD), "")


def needed(template: Template, share: float) -> int:
    return math.ceil(share * len(template.tokens) - 1e-9)


def token_counts(docs: DataFrame, text: str, templates: Sequence[Template]) -> dict[str, int]:
    """How often each template token stands in the corpus; as many rows as templates have tokens."""
    vocabulary = sorted({t for template in templates for t in template.tokens})
    told = F.filter(words_of(F.col(text)), lambda w: w.isin(*vocabulary))
    counts = docs.select(F.explode(told).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()
    return {t: 0 for t in vocabulary} | {r["token"]: r["n"] for r in counts}


def _phrases(df: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """``n_base``, ``first_word``, ``last_word`` and the array ``_base`` of labels from the words ``_w``."""
    df = df.withColumn("_joined", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")))
    spaces = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
    none = F.lit(None).cast("bigint")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        there = F.contains("_joined", F.lit(f" {phrase} "))
        parts = F.split("_joined", f" {phrase}(?= )")
        size = len(phrase.split())
        counts.append(F.when(there, F.size(parts) - 1).otherwise(0).cast("bigint"))
        firsts.append(F.when(there, spaces(F.get(parts, F.lit(0))).cast("bigint")).otherwise(none))
        after = spaces(F.element_at(parts, -1)) - 1  # words after the last place
        lasts.append(F.when(there, (F.size("_w") - after - size).cast("bigint")).otherwise(none))
        labels.append(F.when(there, F.lit(label)))
    first = F.least(*firsts) if len(firsts) > 1 else firsts[0]
    last = F.greatest(*lasts) if len(lasts) > 1 else lasts[0]
    found = F.array_distinct(F.array_compact(F.array(*labels)))
    return df.withColumns({"n_base": reduce(Column.__add__, counts), "first_word": first, "last_word": last, "_base": found}).drop("_joined")


def scan(
    docs: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    share: float = 0.8, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns of ``docs`` as a struct ``_row`` with words, phrase places, ``base_labels``, ``labels`` and ``score``.

    What the scan finds is written without the texts. Blocks carry the hash of their
    text, so the labels of equal texts are found together and joined back by it; rows
    with no block to test take no part in the join.
    """
    keep = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    counts = token_counts(packed, "_text", templates)
    order = sorted(counts, key=lambda t: (counts[t], t))
    place = {t: k for k, t in enumerate(order)}
    span = max(len(t.text.split()) for t in templates)

    prefixes = []
    for number, template in enumerate(templates):
        tokens, need = sorted(template.tokens, key=place.__getitem__), needed(template, share)
        prefixes += [(t, number, template.label, k, len(tokens), need, tokens) for k, t in enumerate(tokens[: len(tokens) - need + 1])]
    first_tokens = F.array(*[F.lit(t) for t in sorted({p[0] for p in prefixes})])
    least = min(p[5] for p in prefixes)

    rows = packed.withColumn("_w", words_of(F.col("_text")))
    rows = _phrases(rows, phrases).withColumn("n_words", F.size("_w").cast("bigint"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((F.size("_w") - span) / span).cast("int") - 1, F.lit(0)))
    blocks = F.transform(starts, lambda k: F.slice(F.col("_w"), k * span + 1, F.lit(2 * span)))
    in_order = F.array(*[F.lit(t) for t in order])
    near = F.filter(blocks, lambda b: F.arrays_overlap(b, first_tokens))
    sets = F.filter(F.transform(near, lambda b: F.array_intersect(in_order, b)), lambda s: F.size(s) >= least)
    rows = rows.withColumn("_sets", F.when(F.arrays_overlap("_w", first_tokens), F.array_distinct(sets)))
    rows = rows.withColumn("_key", F.when(F.size("_sets") > 0, F.sha2("_text", 256)))
    scanned = written(rows.select("_row", "n_words", "n_base", "first_word", "last_word", "_base", "_key", F.when(F.col("_key").isNotNull(), F.col("_sets")).alias("_sets")), "blocks")

    spark = docs.sparkSession
    table = spark.createDataFrame(prefixes, "_token string, template int, label string, _at int, _size int, _need int, _tokens array<string>")
    sets = scanned.filter("_key is not null").select("_key", F.explode("_sets").alias("_set"))
    tokens = sets.select("_key", "_set", F.posexplode("_set").alias("_place", "token")).filter(F.col("_place") <= F.size("_set") - least)
    pairs = tokens.join(table, F.col("token") == F.col("_token"))
    left = F.least(F.col("_size") - F.col("_at"), F.size("_set") - F.col("_place"))
    # the tokens before this one can be common as well: both sides have at most so many
    before = F.least("_at", "_place")
    pairs = pairs.filter((F.size("_set") >= F.col("_need")) & (F.col("_place") <= F.size("_set") - F.col("_need")) & (before + left >= F.col("_need")))
    common = F.size(F.array_intersect("_set", "_tokens"))
    found = pairs.withColumn("_common", common).filter(F.col("_common") >= F.col("_need"))
    best = found.groupBy("_key").agg(F.collect_set("label").alias("_more"), F.max(F.col("_common") / F.col("_size")).alias("_best"))
    best = written(best.withColumnRenamed("_key", "_of"), "labels")

    named = ["_row", "n_words", "n_base", "first_word", "last_word", "_base"]
    tested = scanned.filter("_key is not null").join(best, F.col("_key") == F.col("_of"), "left").select(*named, "_more", "_best")
    others = scanned.filter("_key is null").select(*named, F.lit(None).cast("array<string>").alias("_more"), F.lit(None).cast("double").alias("_best"))
    listed = lambda labels: F.array_join(F.array_sort(labels), ",")
    labels = F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>")))
    score = F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0)))
    return tested.unionByName(others).select(
        "_row", "n_words", "n_base", "first_word", "last_word", listed(F.col("_base")).alias("base_labels"), listed(labels).alias("labels"), score.alias("score")
    )
