"""SimHash near-duplicates with a pigeonring filter.

A fingerprint of 64 bits is cut into a ring of ``SEGMENTS`` equal segments. If two
differ in at most ``budget`` bits, some start on the ring has *all* its chains
within proportion: the first ``l`` segments from there differ in at most
``l * budget / SEGMENTS`` bits, for every ``l``. Whole numbers make that, for eight
segments and three bits: 0, 0, 1, 1, 1, 2, 2, 3.

So candidates must agree, from some start, on the first two segments and differ in
at most one bit over the next three. Those three hold a difference in one segment
at most, hence two of them are equal: a fingerprint is filed under three keys of
32 bits per start, and only fingerprints with an equal key meet. The chain test
then drops most of them before the full Hamming test.

Copies share a fingerprint and enter once. Fingerprints under one key are dealt
into blocks of bounded size, and every pair of blocks is one list; each list is
tested in numpy and returns a spanning forest of its links, never all its pairs.
Components over these links equal those over all links.

Defined results: a null or empty text has no shingle and fingerprint zero, linked
like any other; fewer words than a shingle count as one; repeated rows share a
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.sources.scratch import written

SEGMENTS, WIDTH = 8, 8
BUDGET = 3
CHAIN = tuple(length * BUDGET // SEGMENTS for length in range(1, SEGMENTS + 1))
#: Pairs among the three segments after the first two of a chain.
KEPT = ((2, 3), (2, 4), (3, 4))
BLOCK = 512
SEED = 42


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """Fingerprint of one text as an unsigned number."""
    tokens = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not tokens:
        return 0
    if len(tokens) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)]
    else:
        joined, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens])
        starts = [0, *ends[:-1].tolist()]
        stops = (ends - 1).tolist()
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops[words - 1 :], strict=False)]
    ones, step = np.zeros(64, dtype=np.int64), 65_536
    for at in range(0, len(hashes), step):
        part = np.array(hashes[at : at + step], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None, words: int = 3) -> DataFrame:
    """``keep`` columns of ``docs`` as a struct ``_row`` and the ``fingerprint`` as a signed 64-bit number."""
    keep = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    schema = packed.select("_row", F.lit(0).cast("bigint").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint_of(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["_row", "fingerprint"])

    return packed.mapInArrow(run, schema)


def _segment(value: Column, k: int) -> Column:
    return F.call_function("shiftrightunsigned", value, F.lit(WIDTH * (k % SEGMENTS))).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _keys(value: Column) -> Column:
    """One number per start and kept pair of segments: their 32 bits above the number of the key."""
    keys = []
    for start in range(SEGMENTS):
        for pair, (i, j) in enumerate(KEPT):
            key = F.lit(start * len(KEPT) + pair).cast("bigint")
            for part in (0, 1, i, j):
                key = F.call_function("shiftleft", key, F.lit(WIDTH)).bitwiseOR(_segment(value, start + part))
            keys.append(key)
    return F.array(*keys)


def chain_holds(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Whether every chain from ``start`` stays within its share of the budget."""
    differing = (a ^ b).view(np.uint64)
    total = np.zeros(differing.shape, dtype=np.int64)
    alive = np.ones(differing.shape, dtype=bool)
    for length, budget in enumerate(CHAIN):
        shift = np.uint64(WIDTH * ((start + length) % SEGMENTS))
        total += np.bitwise_count((differing >> shift) & np.uint64((1 << WIDTH) - 1))
        alive &= total <= budget
    return alive


def _forest(values: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect what is linked in one list; at most one fewer than its values."""
    left = np.ones(len(values), dtype=bool)
    links: list[tuple[int, int]] = []
    for seed in range(len(values)):
        if not left[seed]:
            continue
        left[seed] = False
        front = [seed]
        while front:
            at = front.pop()
            rest = np.flatnonzero(left)
            near = rest[chain_holds(values[rest], np.broadcast_to(values[at], rest.shape), start)]
            left[near] = False
            front.extend(near.tolist())
            links.extend((int(values[at]), int(values[k])) for k in near)
    return links


def _link_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        starts = (keys >> np.int64(4 * WIDTH)) // len(KEPT)
        lists = batch.column(1)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sizes = np.diff(ends)
        a, b = [], []
        two = np.flatnonzero(sizes == 2)
        for start in np.unique(starts[two]):
            at = ends[:-1][two[starts[two] == start]]
            holds = chain_holds(flat[at], flat[at + 1], int(start))
            a.append(flat[at][holds])
            b.append(flat[at + 1][holds])
        for k in np.flatnonzero(sizes > 2):
            for x, y in _forest(flat[ends[k] : ends[k + 1]], int(starts[k])):
                a.append(np.array([x]))
                b.append(np.array([y]))
        none = np.array([], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"]
        )


def links(fingerprints: DataFrame, column: str = "fingerprint") -> DataFrame:
    """Links ``a``, ``b`` that connect distinct fingerprints of at most ``BUDGET`` differing bits.

    Keys that several fingerprints share are counted first. A key with more than
    ``BLOCK`` of them is dealt into blocks by hash, and each block meets each other.
    """
    filed = fingerprints.select(F.col(column).alias("value")).distinct().select("value", F.explode(_keys(F.col("value"))).alias("key"))
    shared = filed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("key", "_key")
    together = filed.join(shared, F.col("key") == F.col("_key")).withColumn("_blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("value"), F.col("_blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.struct(F.least(F.col("_own"), other).alias("i"), F.greatest(F.col("_own"), other).alias("j")),
    )
    dealt = together.withColumn("_own", own).select("key", "value", F.explode(meets).alias("_meet"))
    lists = dealt.groupBy("key", "_meet").agg(F.collect_list("value").alias("values")).filter(F.size("values") > 1)
    return lists.select("key", "values").mapInArrow(_link_lists, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Fingerprints are computed once and written; links and components work on
    distinct fingerprints, so a group of copies counts as one whatever its size.
    """
    prints = written(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), text), text, ["doc_id"]).select("_row.doc_id", "fingerprint"), "fingerprints")
    found = written(components(links(prints)).withColumnsRenamed({"node": "_node", "component": "_root"}), "components")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    rooted = least.join(found, F.col("fingerprint") == F.col("_node"), "left").select(
        "fingerprint", "first_id", F.coalesce("_root", "fingerprint").alias("root")
    )
    class_ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "_of")
    classes = rooted.join(class_ids, F.col("root") == F.col("_of")).select(F.col("fingerprint").alias("_print"), "component_id")
    hex16 = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(classes, F.col("fingerprint") == F.col("_print")).select("doc_id", hex16.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one with the least id.

    Rows without an id come after all others. Of rows with one id the text with the
    least hash stays, of equal rows one; only those are numbered. The texts are not
    shuffled unless the list of what goes is too large to broadcast.
    """
    key = [F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash")]
    named = docs.select(*key, F.col(text).alias("text"))
    prints = written(with_fingerprint(named, "text", ["doc_id", "text_hash"]).select("_row.*", "fingerprint"), "fingerprints")
    found = written(components(links(prints)).withColumnsRenamed({"node": "_node", "component": "_root"}), "components")
    units = prints.groupBy("fingerprint", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    rooted = units.join(found, F.col("fingerprint") == F.col("_node"), "left").select(
        F.coalesce("_root", "fingerprint").alias("root"), place.alias("place"), "copies"
    )
    first = rooted.groupBy("root").agg(F.min("place").alias("first")).withColumnRenamed("root", "_of")
    judged = rooted.join(first, F.col("root") == F.col("_of")).withColumn("goes", F.col("place") != F.col("first"))
    odd = judged.filter(F.col("goes") | (F.col("copies") > 1)).select(
        F.col("place.doc_id").alias("_id"), F.col("place.text_hash").alias("_hash"), "goes"
    )
    odd = written(odd, "dropped")

    packed = docs.select(F.struct(*docs.columns).alias("whole"), *key)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    single = packed.join(odd, same, "left_anti").select("whole")
    repeated = packed.join(odd.filter(~F.col("goes")), same, "left_semi")
    numbered = repeated.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("text_hash")))
    return single.unionByName(numbered.filter("_n = 1").select("whole")).select("whole.*")
