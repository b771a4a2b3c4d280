"""Token ids in compressed blocks with a shared dictionary and an offset index.

Documents are range-partitioned and sorted by id, encoded, and each is compressed
alone by zstandard with one dictionary, trained on the serialized ids of a bounded
sample. A block row holds the frames of neighbouring documents one after another,
the ids of these documents, the offset of each frame and the hash of the
dictionary. So one document is read by finding its block, cutting its frame out by
the offsets, and decompressing that alone.

Files are written and committed by Spark, as Parquet, in any store that Spark
writes, and a lost executor's tasks are done again: ``blocks`` and ``dictionary``
below one folder. Ids are unsigned 16-bit numbers if the vocabulary fits, else
32-bit, little-endian.

The number of ids before a document is the sum over earlier parts, a table of one
row per part, plus a running count kept in the block.

Defined results: a null or empty text holds the end id alone; repeated ids stay
next to each other, ordered by text; a null id comes first; an empty table gives
no blocks.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import new_folder

DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
BLOCK_DOCS = 256
MEMO = 600_000
LONGEST_IN_MEMO = 64
PARTS_AT_ONCE = 512
STRETCH = 1_000_000
SPACE = " \t\n\r\x0b\x0c"
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Cuts at places where byte-level BPE begins a new piece whatever is around: before
#: white space that follows none, and between a letter and a comma or full stop.
#: No run can end earlier and still match, so none gives characters back.
PART = re.compile(rf"[{SPACE}]*+(?:[{LETTER}]++(?=[{SPACE},.]|\Z)|[^{SPACE}]++)|[{SPACE}]++")
#: Other white space and separators, for which texts are encoded in one piece.
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

BLOCKS = (
    "part int, first_doc bigint, last_doc bigint, start_in_part bigint, n_tokens bigint, dictionary_sha256 string, "
    "doc_ids array<bigint>, counts array<bigint>, offsets array<bigint>, frames binary"
)


class Encoder:
    """The tokenizers library with a bounded memo of text parts that come again.

    The memo has two generations: when ``memo`` is full it becomes ``aged``, from which
    parts that come again are taken over.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)  # the file spells a byte as one character
        for piece, at in vocabulary.items():
            self.bytes_of[at] = len(piece)
        self.memo: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _joined(self, parts: list[str]) -> list[bytes]:
        """``_ids`` of parts that begin with white space and end without: one text, cut again by the bytes of its pieces."""
        text = "".join(parts)
        if any(t in text for t in self.added):
            return self._ids(parts)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends, wanted = np.cumsum(self.bytes_of[ids]), np.cumsum(list(map(len, parts)))
        if not text.isascii():  # from characters to bytes of UTF-8
            chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            wanted = np.cumsum(1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))[wanted - 1]
        at = np.searchsorted(ends, wanted)
        if not len(ends) or at[-1] != len(ends) - 1 or not np.array_equal(ends[at], wanted):
            return self._ids(parts)
        raw, stops = ids.tobytes(), ((at + 1) * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts that the memo lacks go into it; too long parts are returned and not kept."""
        short = [p for p in parts if len(p) <= LONGEST_IN_MEMO and p[0] in SPACE and p[-1] not in SPACE]
        for at in range(0, len(short), PARTS_AT_ONCE):
            some = short[at : at + PARTS_AT_ONCE]
            self.memo.update(zip(some, self._joined(some), strict=True))
        once, other = {}, list(parts.difference(short))
        for p, ids in zip(other, self._ids(other), strict=True):
            (self.memo if len(p) <= LONGEST_IN_MEMO else once)[p] = ids
        return once

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Serialized ids of each text."""
        at = 0
        while at < len(texts):
            cut, chars = [], 0
            while at < len(texts) and (not cut or chars < STRETCH):
                text = texts[at] or ""
                whole = UNUSUAL.search(text) or any(t in text for t in self.added)
                cut.append(PART.findall(text) if not whole else [text])
                chars, at = chars + len(text), at + 1
            if len(self.memo) > MEMO // 2:
                self.memo, self.aged = {}, self.memo
            known, aged = self.memo, self.aged
            new = set().union(*cut).difference(known)
            again = aged.keys() & new  # looks up the new parts, where set.intersection would go through all of the memo
            known.update(zip(again, map(aged.__getitem__, again), strict=True))
            once = self._learn(new.difference(again))
            look = (lambda p: once[p] if p in once else known[p]) if once else known.__getitem__  # noqa: B023
            yield from [b"".join(map(look, parts)) for parts in cut]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, on one thread as Spark gives a task one core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer: str, doc_id: str, text: str, rows: int = 400, chars: int = 20_000) -> bytes:
    """Dictionary from the serialized ids of at most ``rows`` documents, of longer ones those of their first ``chars`` characters.

    Those with the least hash of their id are taken, so reruns train the same one.
    Hashes are ranked alone, so no task sends texts to the driver but of the sample.
    Too few documents to train on are the dictionary themselves, as plain content;
    without any text there is none, and frames go without.
    """
    hashes = docs.select(F.xxhash64(doc_id).alias("_at")).orderBy("_at").limit(rows).collect()
    last = max((row._at for row in hashes), default=0)
    sample = docs.filter(F.xxhash64(doc_id) <= last).select(F.left(text, F.lit(chars)).alias("_text")).filter("_text <> ''")
    texts = sorted(row._text for row in sample.limit(rows).collect())
    ids = list(encoder(tokenizer).encode_all(texts))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, ids).as_bytes()
    except zstandard.ZstdError:
        return b"".join(ids)[-DICTIONARY_BYTES:]


def _zstd(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Write ``blocks`` and ``dictionary`` of all documents below ``folder``."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, doc_id, text)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        encode, zstd = encoder(tokenizer), zstandard.ZstdCompressor(level=LEVEL, **_zstd(shared.value))
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), BLOCK_DOCS):
                ids = [x + end for x in encode.encode_all(texts[at : at + BLOCK_DOCS])]
                frames = [zstd.compress(x) for x in ids]
                counts = [len(x) // encode.dtype.itemsize for x in ids]
                names = batch.column(0).slice(at, BLOCK_DOCS).to_pylist()
                ends = np.cumsum([0, *map(len, frames)]).tolist()
                row = [part, names[0], names[-1], start, sum(counts), digest, names, counts, ends, b"".join(frames)]
                start += sum(counts)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], names=_NAMES)

    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{folder}/blocks")


_NAMES = [field.split()[0] for field in BLOCKS.split(", ")]
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary()}
_TYPES = [_KINDS[field.split()[1]] for field in BLOCKS.split(", ")]


def read_ids(frame: bytes, dictionary: bytes, dtype: str = "<u2") -> np.ndarray:
    """Ids of one document from its frame alone."""
    return np.frombuffer(zstandard.ZstdDecompressor(**_zstd(dictionary)).decompress(frame), dtype=dtype)


def read_one(blocks: DataFrame, dictionary: bytes, doc_id: int, dtype: str = "<u2") -> np.ndarray:
    """Ids of one document: Parquet statistics find its block, the offsets its frame."""
    held = blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    at = F.array_position("doc_ids", F.lit(doc_id).cast("bigint")).cast("int")
    begin, stop = F.get("offsets", at - 1), F.get("offsets", at)
    cut = held.filter(at > 0).select(F.substring(F.col("frames"), (begin + 1).cast("int"), (stop - begin).cast("int")).alias("frame"))
    return read_ids(bytes(cut.first().frame), dictionary, dtype)


def digests(folder: str, spark, dtype: str = "<u2") -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first().dictionary)
    digest, shared = hashlib.sha256(dictionary).hexdigest(), spark.sparkContext.broadcast(dictionary)
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # two numbers per task of the write, so the frames need no shuffle
    placed = blocks.join(F.broadcast(starts), F.col("part") == F.col("_part")).select(
        (F.col("start_in_part") + F.col("_before")).alias("start"), "dictionary_sha256", "doc_ids", "counts", "offsets", "frames"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor(**_zstd(shared.value))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError(f"block needs dictionary {row['dictionary_sha256']}, the folder holds {digest}")
                sums, ends, frames = [], row["offsets"], row["frames"]
                for a, b in zip(ends, ends[1:], strict=False):
                    ids = np.frombuffer(zstd.decompress(frames[a:b]), dtype=dtype)
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                counts = np.array(row["counts"], dtype=np.int64)
                start = row["start"] + np.concatenate([[0], np.cumsum(counts)[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(counts), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def store_and_read(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the store to a new folder in the shared storage and read its digests back."""
    folder = new_folder(docs.sparkSession, "tokens")
    write(docs, folder, tokenizer, doc_id, text)
    return digests(folder, docs.sparkSession, encoder(tokenizer).dtype.str)
