"""Substring search for a table of tokens, pruned by an inverted index of character n-grams.

The index is built where the scan has the texts: each task cuts its rows into blocks and
writes one row per block, with the block's n-grams of one to ``LONGEST`` characters, and for
each the delta-coded numbers of the rows that hold it. A token is in a text only if all its
n-grams are, so a token's rows in a block are the intersection of its longest n-grams'
postings; for tokens of up to ``LONGEST`` characters that is the answer, longer ones are
looked for in the few texts left. No pair of token and text is built that fails the index.

Blocks are small and few to a file, so neither a writer nor a reader of the index holds many:
Parquet looks at its buffers only every hundred rows, and a reader's batch is a file's rows.

Tokens are packed into groups of ``TOKENS_AT_ONCE``, and a block meets every group by an
equality join on the group's number, whose sides Spark broadcasts or shuffles by their sizes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

LONGEST = 3
BLOCK_ROWS, BLOCK_CHARS, BLOCKS_IN_FILE = 1 << 16, 1 << 19, 16
TOKENS_AT_ONCE, ROWS_AT_ONCE = 1 << 14, 10_000

_INDEX = "texts array<string>, grams array<string>, postings array<binary>"


def encoded(numbers: Sequence[int]) -> bytes:
    """Rising numbers as their differences, seven bits a byte, the high bit on all but the last byte of each."""
    out, before = bytearray(), 0
    for number in numbers:
        gap, before = number - before, number
        while gap > 127:
            out.append(gap & 127 | 128)
            gap >>= 7
        out.append(gap)
    return bytes(out)


def decoded(postings: bytes) -> np.ndarray:
    raw = np.frombuffer(postings, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.cumsum(np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts))


def _encoded_all(numbers: np.ndarray, first: np.ndarray) -> pa.Array:
    """:func:`encoded` of each list in ``numbers``, which begin at ``first``."""
    gaps = np.diff(numbers, prepend=0)
    gaps[first] = numbers[first]
    sizes = np.ones(len(gaps), np.int64)
    for bits in range(7, 63, 7):
        sizes += gaps >> bits > 0
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for place in range(int(sizes.max(initial=0))):
        more = sizes > place
        out[starts[more] + place] = gaps[more] >> 7 * place & 127 | np.where(sizes[more] > place + 1, 128, 0)
    offsets = np.append(starts[first], len(out)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _decoded_all(postings: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all postings, one list after another, and where each list begins and the last ends."""
    offsets = np.frombuffer(postings.buffers()[1], np.int32)[postings.offset : postings.offset + len(postings) + 1]
    raw = np.frombuffer(postings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = np.flatnonzero(raw < 128)
    begins = np.searchsorted(ends, offsets - offsets[0])
    if not len(ends):
        return np.empty(0, np.int64), begins
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    gaps = np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)
    sums = np.concatenate([[0], np.cumsum(gaps)])
    return sums[1:] - np.repeat(sums[begins[:-1]], np.diff(begins)), begins


def _inverted(texts: list[str]) -> tuple[list[str], pa.Array]:
    """N-grams of one to ``LONGEST`` characters, and for each the coded numbers of the texts that hold it."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    chars, letter = np.unique(codes, return_inverse=True)
    gram, spelled, names, coded = np.zeros(len(codes), np.int64), [""], [], []
    letters = chars.tobytes().decode("utf-32-le")
    for n in range(1, LONGEST + 1):
        reach = len(codes) - n + 1
        if reach <= 0:
            break
        kinds, gram = np.unique(gram[:reach] * len(chars) + letter[n - 1 :], return_inverse=True)
        spelled = [spelled[k // len(chars)] + letters[k % len(chars)] for k in kinds.tolist()]
        inside = owner[:reach] == owner[n - 1 :]
        held = np.unique(gram[inside] * len(texts) + owner[:reach][inside])
        own, numbers = np.divmod(held, len(texts))
        first = np.flatnonzero(np.diff(own, prepend=-1))
        names += [spelled[k] for k in own[first].tolist()]
        coded.append(_encoded_all(numbers, first))
    return names, pa.concat_arrays(coded) if coded else pa.array([], pa.binary())


def build_grams(rows: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The index, written: one row per block with its ``keep`` columns, texts, n-grams and postings.

    Rows without a text match nothing and are left out.
    """
    packed = rows.filter(F.col(text).isNotNull()).select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    row_type = packed.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                before = int(lengths[at - 1]) if at else 0
                end = max(at + 1, min(at + BLOCK_ROWS, int(np.searchsorted(lengths, before + BLOCK_CHARS, side="right"))))
                part = batch.slice(at, end - at)
                at = end
                names, coded = _inverted(part.column(1).to_pylist())
                whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                columns = [part.column(0), part.column(1), pa.array(names, pa.string()), coded]
                yield pa.RecordBatch.from_arrays([whole(c) for c in columns], names=["rows", "texts", "grams", "postings"])

    return written(packed.mapInArrow(run, f"rows array<{row_type}>, {_INDEX}"), "grams", BLOCKS_IN_FILE)


def _cut(token: str) -> list[str]:
    size = min(LONGEST, len(token))
    return list({token[k : k + size] for k in range(len(token) - size + 1)})


class _Block:
    """The texts of a block, and which of them hold an n-gram."""

    def __init__(self, texts: pa.Array, grams: pa.Array, postings: pa.BinaryArray):
        self.texts = texts.to_pylist()
        self.places = dict(zip(grams.to_pylist(), range(len(grams)), strict=True))
        self.numbers, self.begins = _decoded_all(postings)
        self.masks: dict[str, np.ndarray] = {}

    def holding(self, gram: str) -> np.ndarray:
        if gram not in self.masks:
            place = self.places[gram]
            self.masks[gram] = np.zeros(len(self.texts), bool)
            self.masks[gram][self.numbers[self.begins[place] : self.begins[place + 1]]] = True
        return self.masks[gram]

    def matches(self, token: str, grams: list[str]) -> list[int]:
        """Places of the texts that hold the token."""
        if not all(g in self.places for g in grams):
            return []
        left = self.holding(grams[0])
        for gram in grams[1:]:
            left = left & self.holding(gram)
        found = np.flatnonzero(left).tolist()
        return found if len(token) <= LONGEST else [k for k in found if token in self.texts[k]]


def token_search(index: DataFrame, tokens: DataFrame, token: str = "token") -> DataFrame:
    """``token`` and the kept columns of each row whose text holds it; repeated tokens count once, NULL and empty ones never.

    Case counts: lower-case both sides for a search that ignores it.
    """
    row_fields = index.schema["rows"].dataType.elementType
    asked = written(tokens.select(F.col(token).alias("token")).filter("token <> ''").distinct(), "tokens")
    groups = max(1, -(-asked.count() // TOKENS_AT_ONCE))
    packed = asked.groupBy(F.pmod(F.xxhash64("token"), F.lit(groups)).alias("_group")).agg(F.collect_list("token").alias("tokens"))
    packed = written(packed, "token-groups")
    blocks = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_of"))
    met = blocks.join(packed, F.col("_of") == F.col("_group")).select("rows", "texts", "grams", "postings", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, cuts = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                rows, texts, grams, coded, wanted = (batch.column(c)[at].values for c in range(5))
                if group is None or not wanted.equals(group):
                    group, cuts = wanted, [(x, _cut(x)) for x in wanted.to_pylist()]
                block = _Block(texts, grams, coded)
                names, places = [], []
                for k, (name, cut) in enumerate(cuts):
                    own = block.matches(name, cut)
                    places += own
                    names += [name] * len(own)
                    if len(places) >= ROWS_AT_ONCE or (places and k == len(cuts) - 1):
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), rows.take(pa.array(places))], names=["token", "_row"])
                        names, places = [], []

    found = met.mapInArrow(run, f"token string, _row {row_fields.simpleString()}")
    return found.select("token", "_row.*")
