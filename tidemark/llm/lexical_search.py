"""Ranked lexical search with K2-treaps over term-document grids.

*Index.* Each task cuts its documents into blocks of bounded size. A block is a grid:
its terms are rows, the most frequent first, and its documents are columns, by id. A
cell with a posting holds the term's impact in the document. The grid is a K2-tree: the
square is quartered down to single cells, empty quarters are left out, and each node has
one byte for the quarters it has. It is a treap by its maxima: each node keeps the
largest impact below it, written as the difference to its parent's. Masks and
differences are compressed level by level. All terms of all documents are indexed, and
no text is shuffled; a block is one row of the index table.

*Search.* An item's terms are rows of a block. Its paths start at the root together: a
state is a range of documents with, for each of the terms, the node that covers both. The
sum of weight times maximum bounds the score of every document in the range. The best
states are opened first, many at a time: each gives two half ranges, in which every term
goes to its own quarter or drops out. A single document's bound is its score. States
below the item's ``k``-th best score so far in this task go unopened. Each block gives an item at
most ``k`` documents, and the best of all blocks are ranked by two windows.

Items meet blocks in groups of ``ITEMS_AT_ONCE``, by an equality join on the number of the
group, whose size tells Spark whether to broadcast the items.

Defined results: a null text has no term, counts in no statistic and matches nothing;
equal scores stand by id, null ids first; repeated documents rank each; rows with the
same item are one item; an item without terms, and a score of 0, give no row; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SCALE = 1_000_000_000
BLOCK_POSTINGS, BLOCK_DOCS = 1 << 20, 1 << 15
ITEMS_AT_ONCE = 512
OPENED = 256
TOP = 50


def n_terms(text: Column) -> Column:
    """Terms of a text, with repeats."""
    return F.coalesce(F.size(F.array_remove(F.split(text, NO_TERM), "")), F.lit(0)).cast("bigint")


def terms_of(text: str | None) -> list[bytes]:
    """Terms as UTF-8; lower-casing bytes changes A-Z alone."""
    return TERM.findall((text or "").encode().lower())


# ---- the K2-treap of one block


def _spread(values: np.ndarray) -> np.ndarray:
    """Every second bit, from the low 32 bits of each value."""
    out = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = (out | (out << np.uint64(shift))) & np.uint64(mask)
    return out


def build_tree(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int) -> bytes:
    """Compressed tree of a square of ``2 ** height``: per level the masks of its nodes and the maxima of their children."""
    codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(codes)
    codes, maxima = codes[order], impacts[order].astype(np.int64)
    levels = []
    for _ in range(height):
        parents = codes >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        masks = np.bitwise_or.reduceat(np.uint8(1) << (codes & np.uint64(3)).astype(np.uint8), first)
        above = np.maximum.reduceat(maxima, first)
        less = np.repeat(above, np.diff(np.append(first, len(codes)))) - maxima
        levels.append((masks, less.astype("<u4")))
        codes, maxima = parents[first], above
    levels.reverse()
    sizes = np.array([height, int(maxima[0]) if len(maxima) else 0, *[len(m) for m, _ in levels]], dtype="<u8")
    body = b"".join([m.tobytes() for m, _ in levels] + [d.view(np.uint8).reshape(-1, 4).T.tobytes() for _, d in levels])
    return np.uint32(len(sizes)).tobytes() + sizes.tobytes() + zstandard.ZstdCompressor(level=1).compress(body)


class Tree:
    """All nodes of a tree in level order, the single cells included: ``mask``, ``child`` (number of the first child) and ``top``."""

    def __init__(self, packed: bytes):
        n = int(np.frombuffer(packed, "<u4", 1)[0])
        sizes = np.frombuffer(packed, "<u8", n, offset=4)
        body = zstandard.ZstdDecompressor().decompress(packed[4 + 8 * n :])
        self.height, top = int(sizes[0]), int(sizes[1])
        counts = sizes[2:].astype(np.int64)
        masks = np.frombuffer(body, np.uint8, int(counts.sum()))
        children = np.bitwise_count(masks).astype(np.int64)
        self.mask = masks
        self.child = 1 + np.concatenate([[0], np.cumsum(children)])[:-1]
        self.top = np.empty(1 + int(children.sum()), dtype=np.int64)
        self.top[0] = top
        at, node = int(counts.sum()), 0
        for count in counts.tolist():
            own = np.repeat(self.top[node : node + count], children[node : node + count])
            less = np.frombuffer(body, np.uint8, 4 * len(own), offset=at).reshape(4, -1).T
            at += 4 * len(own)
            start = 1 + int(children[:node].sum())
            self.top[start : start + len(own)] = own - np.ascontiguousarray(less).view("<u4").ravel()
            node += count

    def quarter(self, nodes: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The child of each node in that quarter, -1 where there is none or no node."""
        masks = np.where(nodes >= 0, self.mask[np.maximum(nodes, 0)], 0).astype(np.int64)
        there = (masks >> which) & 1
        before = np.bitwise_count(masks & ((1 << which) - 1)).astype(np.int64)
        return np.where(there == 1, self.child[np.maximum(nodes, 0)] + before, -1)


def best_documents(tree: Tree, rows: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> list[tuple[int, int]]:
    """``(score, column)`` of the ``k`` best columns above 0 and not below ``floor``, equal scores by column.

    Rows descend jointly; the ``OPENED`` best ranges are opened at a time. Once ``k``
    documents are found, ranges below the worst of them are closed; ranges that can tie
    with it stay, so the search ends with every document that may belong to the best.
    """
    shift = np.array([tree.height - 1])  # of the bit that tells the halves of a range apart; -1: a single document
    column, nodes = np.zeros(1, dtype=np.int64), np.zeros((1, len(rows)), dtype=np.int64)
    bound = (weights * tree.top[nodes]).sum(axis=1)
    found_at, found = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    while len(bound):
        best = np.argpartition(-bound, OPENED)[:OPENED] if len(bound) > OPENED else np.arange(len(bound))
        rest = np.ones(len(bound), dtype=bool)
        rest[best] = False
        own, at, bits = nodes[best], column[best], shift[best]
        row_bits = ((rows[None, :] >> bits[:, None]) & 1) * 2
        below = np.concatenate([tree.quarter(own, row_bits), tree.quarter(own, row_bits + 1)])
        starts, left = np.concatenate([at, at + (1 << bits)]), np.concatenate([bits, bits]) - 1
        bounds = (np.where(below >= 0, tree.top[below], 0) * weights).sum(axis=1)
        fits = (bounds > 0) & (bounds >= floor)
        done = fits & (left < 0)
        if done.any():
            found, found_at = np.concatenate([found, bounds[done]]), np.concatenate([found_at, starts[done]])
            if len(found) >= k:
                order = np.lexsort((found_at, -found))[:k]
                found, found_at = found[order], found_at[order]
                floor = max(floor, int(found[-1]))
        more = fits & (left >= 0)
        bound, column = np.concatenate([bound[rest], bounds[more]]), np.concatenate([column[rest], starts[more]])
        shift, nodes = np.concatenate([shift[rest], left[more]]), np.concatenate([nodes[rest], below[more]])
        if len(bound) and int(bound.min()) < floor:
            open_ = bound >= floor
            bound, column, shift, nodes = bound[open_], column[open_], shift[open_], nodes[open_]
    order = np.lexsort((found_at, -found))[:k]
    return list(zip(found[order].tolist(), found_at[order].tolist(), strict=True))


# ---- index


def _block(ids: list, lengths: list[int], postings: list[tuple[dict[bytes, int], int]], n_docs: int, total: int) -> dict:
    """One row of the index from the documents of a block: ``(term counts, place)`` each."""
    order = sorted(range(len(ids)), key=lambda d: (ids[d] is not None, ids[d] if ids[d] is not None else 0))
    column_of = {d: c for c, d in enumerate(order)}
    df: Counter = Counter()
    for counts, _ in postings:
        df.update(counts.keys())
    terms = sorted(df, key=lambda t: (-df[t], t))
    row_of = {t: r for r, t in enumerate(terms)}
    size = sum(len(counts) for counts, _ in postings)
    rows = np.fromiter((row_of[t] for counts, _ in postings for t in counts), np.int64, size)
    tf = np.fromiter((n for counts, _ in postings for n in counts.values()), np.int64, size)
    each = [len(counts) for counts, _ in postings]
    columns = np.repeat(np.array([column_of[d] for _, d in postings], np.int64), each)
    n = np.repeat(np.array([lengths[d] for _, d in postings], np.int64), each)
    m = 50 + np.array([(50 * int(x) * n_docs) // total for x in lengths], np.int64)[np.repeat(np.array([d for _, d in postings], np.int64), each)] if total else n
    impacts = (SCALE * tf) // (1000 * tf + 20 * m)
    height = max(1, int(max(len(terms), len(ids)) - 1).bit_length())
    return {
        "ids": [ids[d] for d in order], "terms": [t.decode() for t in terms], "df": [df[t] for t in terms],
        "tree": build_tree(rows, columns, impacts, height),
    }


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, written: one row per block with ``ids``, ``terms``, ``df`` (documents of the block with the term), ``tree``, ``n_docs``.

    The corpus' two numbers, documents with a term and terms, come from one aggregate
    before. Documents stay where the scan has them.
    """
    numbers = docs.select(n_terms(F.col(text)).alias("n")).filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    n_docs, total = numbers[0], numbers[1] or 0
    kind = pa.schema([("ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int64())), ("tree", pa.binary()), ("n_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, postings, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            row = _block(ids, lengths, postings, n_docs, total) | {"n_docs": n_docs}
            return pa.RecordBatch.from_pylist([row], schema=kind)

        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                found = terms_of(value.as_py())
                if not found:
                    continue
                counts = Counter(found)
                postings.append((counts, len(ids)))
                ids.append(name.as_py())
                lengths.append(len(found))
                size += len(counts)
                if size >= BLOCK_POSTINGS or len(ids) >= BLOCK_DOCS:
                    yield block()
                    ids, lengths, postings, size = [], [], [], 0
        if ids:
            yield block()

    blocks = docs.select(F.col(doc_id).cast("bigint"), text).mapInArrow(run, "ids array<bigint>, terms array<string>, df array<bigint>, tree binary, n_docs bigint")
    return written(blocks, "treaps")


# ---- search


def _weight(df: Column, n_docs: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.log((2 * n_docs + 2).cast("double") / (2 * df + 1).cast("double"))).cast("bigint")


def weighted_items(index: DataFrame, items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id``, ``terms`` and ``weights`` of the items, without the terms that no document has."""
    terms = items.select(F.col(item_id).alias("item_id"), F.explode(F.array_remove(F.split(F.col(text), NO_TERM), "")).alias("_raw"))
    ascii_lower = F.translate("_raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = terms.select("item_id", ascii_lower.alias("term")).distinct()
    wanted = terms.select(F.col("term").alias("_wanted")).distinct()
    there = index.select(F.explode(F.arrays_zip("terms", "df")).alias("_t"), "n_docs").select("_t.terms", "_t.df", "n_docs")
    df = there.join(wanted, F.col("terms") == F.col("_wanted"), "left_semi").groupBy("terms").agg(F.sum("df").alias("df"), F.max("n_docs").alias("n_docs"))
    weights = df.select(F.col("terms").alias("_term"), _weight(F.col("df"), F.col("n_docs")).alias("w"))
    found = terms.join(weights, F.col("term") == F.col("_term")).groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("_list"))
    return found.select("item_id", F.col("_list.term").alias("terms"), F.col("_list.w").alias("weights"))


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, list[int]] = {}  # per item its best scores so far in this task, a heap of k at most
        for batch in batches:
            for at in range(batch.num_rows):
                ids, terms, packed, items = (batch.column(c)[at] for c in range(4))
                ids, tree, items = ids.as_py(), Tree(packed.as_py()), items.as_py()
                asked = pa.array([t for item in items for t in item["terms"]], pa.string())
                places = pc.fill_null(pc.index_in(asked, value_set=terms.values), -1).to_numpy().astype(np.int64)
                ends = np.cumsum([len(item["terms"]) for item in items])
                owners, docs, scores = [], [], []
                for item, rows in zip(items, np.split(places, ends[:-1]), strict=True):
                    there = rows >= 0
                    if not there.any():
                        continue
                    best = floors.setdefault(item["item_id"], [])
                    floor = best[0] if len(best) == k else 0
                    found = best_documents(
                        tree, rows[there], np.array(item["weights"], dtype=np.int64)[there], k, floor
                    )
                    for score, column in found:
                        owners.append(item["item_id"])
                        docs.append(ids[column])
                        scores.append(score)
                        if len(best) < k:
                            heapq.heappush(best, score)
                        else:
                            heapq.heappushpop(best, score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"]
                )

    return run


def search(index: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``k`` best documents of each item."""
    weighted = written(weighted_items(index, items, item_id, text), "items")
    groups = -(-weighted.count() // ITEMS_AT_ONCE)
    if not groups:
        return items.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    packed = weighted.select(F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int").alias("_group"), F.struct("item_id", "terms", "weights").alias("_item"))
    packed = packed.groupBy("_group").agg(F.collect_list("_item").alias("items"))
    blocks = index.select("ids", "terms", "tree", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_of"))
    met = blocks.join(packed, F.col("_of") == F.col("_group")).select("ids", "terms", "tree", "items")
    found = met.mapInArrow(_searched(k), "item_id bigint, doc_id bigint, score bigint")
    # an item's rows are cut in parts before they meet
    best = [F.desc("score"), F.asc_nulls_first("doc_id")]
    part = Window.partitionBy("item_id", "_part").orderBy(*best)
    cut = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(64))).withColumn("_n", F.row_number().over(part)).filter(F.col("_n") <= k)
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
