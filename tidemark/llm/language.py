"""Language identification by words first, then by ever shorter character n-grams.

A word that the training rows know adds its log frequency in each language. A word
they don't know is cut, from left to right, into the longest known n-grams of at
most ``ORDERS[0]`` characters, and adds the mean of their log frequencies. The
language with the best mean over the words wins, and the score is its share after
the softmax of the sums, tempered by ``TEMPERATURE``.

The classifier counts every word of every labelled row, and the n-grams of these words.
Of these units it keeps those that are at least ``FEWEST`` of all units of their kind in
some language; that bounds the model that each task loads, whatever the corpus. Rarer
words are scored like unknown ones, and are counted in the n-grams and in all sums.

The score says which taught language is nearest, not whether it is one of them, and
it grows with length. That is what ``known`` is for: the mean over the words of 1 for a
word of the model, and else the share of its characters under known n-grams
of at least ``TELLING`` characters. Labelled rows are dealt into two halves by the hash of
their text, and ``known_apart`` is the same by units that rows of the other half have.
``with_limits`` gives the limit for the predicted language: the lower quartile of
``known_apart`` over all its labelled rows, less ``REACH`` times their quartile distance or
``SPREAD``, whichever is larger. A language with one labelled row has the limit 0.

Defined results: a null text or one without a letter is ``und`` with score 0; with
no labelled row every text is ``und``; ties go to the language that sorts first.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.worker import held, packed_with, texts_of
from tidemark.sources.scratch import written

ORDERS = (5, 4, 3, 2, 1)
#: Least share of a unit that the model keeps; 400,000 words of a language are kept whole.
FEWEST = 2.5e-6
#: Units that a task sums up before it sends them on.
UNITS_AT_ONCE = 400_000
SMOOTHING = 0.5
#: Shorter n-grams are known for letters in any order.
TELLING = 4
REACH, SPREAD = 4, 0.03
TEMPERATURE = 0.25
WORD_MEMO, MEMO_BYTES = 400_000, 64 << 20
WORDS_AT_ONCE = 50_000
WORD = re.compile(r"[^\W\d_]+")


def words_in(text: str) -> list[str]:
    """Lower-case runs of letters; squares, fractions and other numbers that ``WORD`` takes for letters end a word."""
    words = WORD.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    return "".join(c if c.isalpha() else " " for w in words for c in (*w, " ")).split()


def sample(docs: DataFrame, doc_id: str, text: str, lang: str, rows_per_language: int, chars_per_row: int) -> DataFrame:
    """``lang`` and ``text`` of the training rows, at most ``rows_per_language`` a language; ``identify`` takes all rows.

    A longer text gives its words up to ``chars_per_row``, or part of one if it starts with a longer word.

    Hashes are ranked alone, and cut in each task before the shuffle. Only rows up to
    a language's last hash, hence few more than it keeps, send their text.
    """
    start = F.substring(F.col(text), 1, chars_per_row)
    whole = F.regexp_replace(F.substring(F.col(text), 1, chars_per_row + 1), r"\p{L}+\z", "")
    short = F.when(F.length(F.col(text)) <= chars_per_row, F.col(text)).otherwise(F.when(whole.rlike(r"\p{L}"), whole).otherwise(start))
    taught = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    taught = taught.select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id)).alias("_at"), short.alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_at"))
    ranked = taught.select("lang", "_at").withColumn("_n", first).filter(F.col("_n") <= rows_per_language)
    last = written(ranked.groupBy(F.col("lang").alias("_lang")).agg(F.max("_at").alias("_last")), "last-hashes")
    near = taught.join(last, (F.col("lang") == F.col("_lang")) & (F.col("_at") <= F.col("_last"))).select("lang", "_at", "text")
    best = Window.partitionBy("lang").orderBy("_at", "text")
    return near.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= rows_per_language).select("lang", "text")


COUNTS = "lang string, unit string, n bigint, halves int"


def _sums(rows: Iterator[tuple[str, int, Callable[[Counter], None]]]) -> Iterator[pa.RecordBatch]:
    """``COUNTS`` of language, half and what adds to their counts, summed until there are ``UNITS_AT_ONCE``."""
    held_back: dict[tuple[str, int], Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, halves), units in held_back.items():
            n = len(units)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array(units.keys(), pa.string()), pa.array(units.values(), pa.int64()), pa.array([halves] * n, pa.int32())],
                names=["lang", "unit", "n", "halves"],
            )
        held_back.clear()

    for at, (lang, halves, add) in enumerate(rows):
        add(held_back.setdefault((lang, halves), Counter()))
        if at % 256 == 255 and sum(map(len, held_back.values())) > UNITS_AT_ONCE:
            yield from out()
    yield from out()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for lang, half, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                yield lang.as_py(), 1 << half.as_py(), lambda into, text=text: into.update(words_in(text.as_py()))

    return _sums(rows())


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def add(into: Counter, word: str, n: int) -> None:
        padded = f"_{word}_"
        for order in ORDERS:
            for at in range(len(padded) + 1 - order):
                unit = padded[at : at + order]
                into[unit] = into.get(unit, 0) + n

    def rows():
        for batch in batches:
            for lang, unit, n, halves in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                yield lang, halves, lambda into, unit=unit, n=n: add(into, unit, n)

    return _sums(rows())


def half_of(text: str) -> Column:
    """0 or 1; equal texts are in one half."""
    return F.xxhash64(F.col(text)).bitwiseAND(F.lit(1)).cast("int")


def fit(training: DataFrame) -> DataFrame:
    """``kind`` (0: word, n: characters), ``unit``, one log frequency per language in ``scores``, and ``halves`` (1, 2 or 3: both).

    ``training`` has ``lang`` and ``text``. Frequencies are add-``SMOOTHING`` estimates over
    each language's units of that kind, rare ones included.
    """
    summed = lambda df: df.groupBy("lang", "unit").agg(F.sum("n").alias("n"), F.bit_or("halves").alias("halves"))
    rows = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", half_of("text").alias("half"), "text")
    words = written(summed(rows.mapInArrow(_words, COUNTS)), "words")
    grams = summed(words.mapInArrow(_grams, COUNTS)).withColumn("kind", F.length("unit"))
    units = written(words.withColumn("kind", F.lit(0)).unionByName(grams), "units")
    totals = units.groupBy("kind", "lang").agg(F.sum("n").alias("_all"), F.count("*").alias("_kinds"))
    totals = written(totals.select(F.col("kind").alias("_kind"), F.col("lang").alias("_lang"), "_all", (F.col("_all") + F.col("_kinds") * SMOOTHING).alias("_mass")), "totals")
    shares = units.join(totals, (F.col("kind") == F.col("_kind")) & (F.col("lang") == F.col("_lang")))
    seen = shares.groupBy("kind", "unit").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts"),
        F.bit_or("halves").alias("halves"), F.max(F.col("n") / F.col("_all")).alias("_share"),
    )
    log = F.log((F.coalesce(F.col("counts")[F.col("_lang")], F.lit(0)) + SMOOTHING) / F.col("_mass"))
    return (
        seen.filter(F.col("_share") >= FEWEST).join(totals, F.col("kind") == F.col("_kind"))
        .groupBy("kind", "unit")
        .agg(F.sort_array(F.collect_list(F.struct("_lang", log.alias("s")))).alias("_by"), F.first("halves").alias("halves"))
        .select("kind", "unit", F.col("_by._lang").alias("langs"), F.col("_by.s").alias("scores"), "halves")
    )


class Model(dict):
    """Word to its row of ``table``, one score per language; new words are worked out by backoff and kept.

    ``words`` and ``grams`` give each unit's row of ``scores`` and ``halves``; ``flat`` holds the scores one
    row after another, not as an object for each number. The last three
    columns of the table are how well known the word is, to all rows and to each half. The table has room for
    ``WORD_MEMO`` new words, fewer where many languages make its rows long.
    """

    def __init__(self, langs: list[str], words: dict[str, int], grams: dict[str, int], scores: np.ndarray, halves: bytes | None = None):
        super().__init__()
        self.langs, self.words, self.grams, self.width = langs, list(words), grams, scores.shape[1]
        self.flat = array("d", np.ascontiguousarray(scores, dtype=np.float64).tobytes())
        self.halves = bytes([3]) * len(scores) if halves is None else halves
        room = max(1000, min(WORD_MEMO, MEMO_BYTES // (8 * (len(langs) + 3))))
        self.at_once = min(WORDS_AT_ONCE, room)
        self.table = np.zeros((len(words) + room, len(langs) + 3))
        if words:
            self.table[: len(words), :-3] = scores[list(words.values())]
            self.table[: len(words), -3:] = 1
        for at, (word, row) in enumerate(words.items()):
            if self.halves[row] != 3:
                self.table[at, -self.halves[row]] = self.told(word, 3 - self.halves[row])
        self.reset()

    @classmethod
    def of(cls, langs: list[str], units: pa.Table) -> Model:
        """From rows of ``kind``, ``unit``, ``scores`` and ``halves``."""
        kinds, names = units.column("kind").to_numpy(), units.column("unit").to_pylist()
        scores = np.asarray(units.column("scores").combine_chunks().flatten(), dtype=np.float64).reshape(-1, max(1, len(langs)))
        words = {names[k]: k for k in np.flatnonzero(kinds == 0).tolist()}
        halves = units.column("halves").to_numpy().astype(np.uint8).tobytes()
        return cls(langs, words, {names[k]: k for k in np.flatnonzero(kinds != 0).tolist()}, scores, halves)

    def reset(self) -> None:
        self.clear()
        self.update((w, k) for k, w in enumerate(self.words))

    def backoff(self, word: str) -> tuple:
        """Mean over the longest known n-grams from left to right; a character nobody knows adds nothing."""
        return self.backed(word)[0]

    def backed(self, word: str) -> tuple[tuple, tuple]:
        """``backoff`` and the shares of the characters that n-grams of ``TELLING`` or more cover, to all rows and each half."""
        padded, at, found, grams, flat, width, told, both = f"_{word}_", 0, [], self.grams, self.flat, self.width, 0, 3
        size = len(padded)
        while at < size:
            for order in ORDERS:
                if at + order <= size and (row := grams.get(padded[at : at + order])) is not None:
                    found.append(flat[row * width : (row + 1) * width])
                    both &= self.halves[row]
                    at += order
                    told += order if order >= TELLING else 0
                    break
            else:
                at += 1
        means = tuple([sum(column) / len(found) for column in zip(*found, strict=True)]) if found else (0.0,) * len(self.langs)
        told /= size
        return means, (told, told, told) if both == 3 else (told, self.told(word, 1), self.told(word, 2))

    def told(self, word: str, half: int) -> float:
        """Share of the characters under n-grams of ``TELLING`` or more, by units of one half."""
        padded, at, told = f"_{word}_", 0, 0
        size = len(padded)
        while at < size:
            for order in ORDERS:
                if at + order <= size and (row := self.grams.get(padded[at : at + order])) is not None and self.halves[row] & half:
                    at += order
                    told += order if order >= TELLING else 0
                    break
            else:
                at += 1
        return told / size

    def __missing__(self, word: str) -> int:
        at = len(self)
        self.table[at, :-3], self.table[at, -3:] = self.backed(word)
        self[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float, tuple]:
        """Language, score, and how well known to all rows and to each half."""
        words = words_in(text or "")
        if not words or not self.langs:
            return "und", 0.0, (0.0, 0.0, 0.0)
        sums = np.zeros(len(self.langs) + 3)
        for at in range(0, len(words), self.at_once):
            if len(self) + self.at_once > len(self.table):
                self.reset()
            sums += self.table[list(map(self.__getitem__, words[at : at + self.at_once]))].sum(axis=0)
        sums, told = sums[:-3], sums[-3:] / len(words)
        best = int(sums.argmax())
        score = float(1 / np.exp(np.maximum(-700.0, TEMPERATURE * (sums - sums[best]))).sum())
        return self.langs[best], score, tuple(told.tolist())


def identify(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` as a struct ``_row`` with ``lang_pred``, ``score``, ``known`` and ``known_apart``; learns from ``training`` alone."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    learnt = written(fit(training.select(F.col(lang).alias("lang"), F.col(text).alias("text"))), "model")
    head = learnt.select("langs").first()
    langs = list(head[0]) if head else []
    units = learnt.select("kind", "unit", "scores", "halves").toArrow()  # bounded by ``FEWEST``
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, units.schema) as out:
        out.write_table(units)
    shared, name = spark.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex
    del units, sink
    packed = packed_with(docs, keep, text, half_of(text).alias("_half"))
    schema = packed.select("_row", F.lit("").alias("lang_pred"), *[F.lit(0.0).alias(c) for c in ("score", "known", "known_apart")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held(("language", name), lambda: Model.of(langs, pa.ipc.open_stream(shared.value).read_all()))
        for batch in batches:
            found = [model.predict(value.as_py()) for value in texts_of(batch, text)]
            apart = [f[2][2 - half] for f, half in zip(found, batch.column("_half").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2][0] for f in found], pa.float64()), pa.array(apart, pa.float64()),
                ],
                names=["_row", "lang_pred", "score", "known", "known_apart"],
            )

    return packed.mapInArrow(run, schema)


def with_limits(found: DataFrame, lang: str = "lang") -> DataFrame:
    """``found`` with ``known_least``, the lower fence of ``known_apart`` over all rows labelled with the predicted language.

    Values count in steps of 1/10,000, so a language's quartiles come from that many sums.
    """
    found = written(found, "identified")
    labelled = found.filter(F.col(f"_row.{lang}").isNotNull() & (F.col("lang_pred") != "und"))
    quartiles = F.percentile(F.round("known_apart", 4), F.array(F.lit(0.25), F.lit(0.75)))
    fences = labelled.groupBy(F.col(f"_row.{lang}").alias("_lang")).agg(quartiles.alias("_q"), F.count("*").alias("_n"))
    low, high = F.col("_q")[0], F.col("_q")[1]
    least = F.when(F.col("_n") > 1, F.greatest(F.lit(0.0), low - REACH * F.greatest(high - low, F.lit(SPREAD)))).otherwise(0.0)
    fences = written(fences.select("_lang", least.alias("_least")), "fences")
    joined = found.join(fences, F.col("lang_pred") == F.col("_lang"), "left")
    return joined.select(*found.columns, F.coalesce("_least", F.lit(0.0)).alias("known_least"))
