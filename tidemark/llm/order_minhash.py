"""Order MinHash fingerprints: similar for a small edit distance, not just for a common vocabulary.

A text's k-mers are runs of ``K`` words. Each gets the number of its occurrence, so
that repeats count, and a hash of both. The hash deals it to one of ``SLOTS`` slots;
each slot selects the ``PICKED`` k-mers with the least hashes, puts them back into
text order and hashes the tuple. Two texts' likeness is the share of slots with
equal tuples among those that either fills: it falls when words change and when
they change places.

One pass deals all k-mers to slots, instead of one pass per hash function. All steps
are array functions on plain longs, linear or n log n in the text: a k-mer's hash and
its position are packed into one long, so sorting needs no structs.

The next document in id order is found without putting all rows into one task: block
bounds, from the quantiles of the ids, cut the ids into blocks, each block also gets
the first row of the block after it, and a window runs inside each block.

Defined results: a null text is empty; an empty text has no k-mer, an empty
fingerprint in every slot, and likeness 1 to another such text, 0 to any other; a
text of fewer than ``K`` words is one k-mer; repeated ids stand next to each other in
the order of their texts; a null id comes first; a single row follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import adjacent, constant_array, present, shifted, text_or_empty, word_array
from tidemark.sources.scratch import written

K = 2
SLOT_BITS = 5
SLOTS = 1 << SLOT_BITS
PICKED = 2
POSITION_BITS = 26
HASH_BITS = 63 - SLOT_BITS - POSITION_BITS
ROWS_PER_BLOCK, MOST_BLOCKS = 1000, 1 << 16

_PLACE = (1 << POSITION_BITS) - 1


def _shift_left(value: Column, bits: int) -> Column:
    return F.call_function("shiftleft", value, F.lit(bits))


def _shift_right(value: Column, bits: int) -> Column:
    return F.call_function("shiftrightunsigned", value, F.lit(bits))


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Array with one long per filled slot, in slot order: the slot above the hash of its tuple."""
    words, n = F.col("_w"), F.size("_w")
    df = df.withColumn("_w", word_array(text_or_empty(text)))
    neighbours = shifted(words, F.greatest(n - (K - 1), F.lit(0)), *range(K))
    hashed = F.transform(neighbours[0], lambda w: F.xxhash64(w))
    for more in neighbours[1:]:
        hashed = F.zip_with(hashed, more, lambda h, w: F.xxhash64(h, w))
    short = F.when(n > 0, F.array(F.xxhash64(F.array_join("_w", " ")))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_h", F.when(n >= K, hashed).otherwise(short))

    # the high bits of the hash above the position: equal k-mers side by side, in text order
    kmer = lambda p: p.bitwiseAND(F.lit(~_PLACE))
    place = lambda p: p.bitwiseAND(F.lit(_PLACE))
    df = df.withColumn("_p", F.sort_array(F.transform("_h", lambda h, i: kmer(h).bitwiseOR(place(i.cast("bigint"))))))
    new = adjacent(F.col("_p"), F.size("_p"), lambda a, b: kmer(a) != kmer(b))
    yes = F.array(F.lit(True))
    runs = F.filter(F.transform(F.concat(yes, new, yes), lambda x, i: F.when(x, i)), lambda i: i.isNotNull())
    df = df.withColumn("_r", F.when(F.size("_p") > 0, runs).otherwise(F.array(F.lit(0))))
    lengths = adjacent(F.col("_r"), F.size("_r"), lambda a, b: b - a)
    occurrence = F.flatten(F.transform(lengths, lambda c: F.sequence(F.lit(0), c - 1)))

    # slot, hash and position in one long; its sort puts a slot's least hashes first
    hash_of = lambda p, o: _shift_right(F.xxhash64(kmer(p), o), 1 + POSITION_BITS)
    entries = F.zip_with("_p", occurrence, lambda p, o: _shift_left(hash_of(p, o), POSITION_BITS).bitwiseOR(place(p)))
    df = df.withColumn("_e", F.sort_array(entries))
    slot = lambda e: _shift_right(e, HASH_BITS + POSITION_BITS)
    low_hash = lambda x: x.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    none = F.lit(-1).cast("bigint")
    earlier = F.slice(F.concat(F.array_repeat(none, PICKED), "_e"), F.lit(1), F.size("_e"))
    picked = present(F.zip_with(earlier, "_e", lambda before, e: F.when((before < 0) | (slot(before) != slot(e)), e)))

    # the picked ones of a slot back in text order: slot, position and hash in one long
    def in_text_order(e: Column) -> Column:
        top = _shift_left(slot(e), HASH_BITS + POSITION_BITS)
        return top.bitwiseOR(_shift_left(place(e), HASH_BITS)).bitwiseOR(low_hash(_shift_right(e, POSITION_BITS)))

    df = df.withColumn("_t", F.sort_array(F.transform(picked, in_text_order)))
    tuples = F.transform("_t", lambda x: F.xxhash64(low_hash(x)))
    for k in range(1, PICKED):
        after = F.slice(F.concat("_t", F.array_repeat(none, k)), F.lit(k + 1), F.size("_t"))
        more = F.zip_with("_t", after, lambda x, y: F.when((y >= 0) & (slot(x) == slot(y)), low_hash(y)))
        tuples = F.zip_with(tuples, more, lambda h, code: F.when(code.isNull(), h).otherwise(F.xxhash64(h, code)))
    df = df.withColumn("_v", tuples)
    before = F.slice(F.concat(F.array(none), "_t"), F.lit(1), F.size("_t"))
    heads = F.zip_with(before, "_t", lambda b, x: F.when((b < 0) | (slot(b) != slot(x)), _shift_left(slot(x), 63 - SLOT_BITS)))
    signature = present(F.zip_with(heads, "_v", lambda head, h: head.bitwiseOR(_shift_right(h, 1 + SLOT_BITS))))
    return df.withColumn(out, signature).drop("_w", "_h", "_p", "_r", "_e", "_t", "_v")


def as_text(signature: Column) -> Column:
    """Sixteen hex digits per filled slot."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of slots with equal tuples among those that either fills; 1 if neither fills any."""
    slots = lambda x: F.transform(x, lambda e: _shift_right(e, 63 - SLOT_BITS))
    filled = F.size(F.array_union(slots(a), slots(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def block_bounds(ids: DataFrame, column: str) -> list[int]:
    """First ids of the blocks after the first: evenly spaced quantiles, one per ``ROWS_PER_BLOCK`` rows, ``MOST_BLOCKS`` at most."""
    blocks = min(MOST_BLOCKS, -(-ids.count() // ROWS_PER_BLOCK))
    if blocks < 2:
        return []
    shares = [k / blocks for k in range(1, blocks)]
    return sorted(set(ids.agg(F.percentile_approx(column, shares, max(10_000, 4 * blocks))).first()[0]))


def block_of(value: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    known, steps = constant_array(bounds, "bigint"), [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def search(found: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(known, found + step - 1) <= value, F.lit(False)), found + step).otherwise(found)

    return F.aggregate(constant_array(steps, "int"), F.lit(0), search)


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``text``, its place ``at``, ``block``, and ``edge`` for copies of the row that follows a block.

    The copies are one row per block, found from the least place of each block. The
    last block gets the first row of all.
    """
    df = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    df = df.withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    bounds = block_bounds(df.select("at"), "at")
    df = df.withColumn("block", block_of(F.col("at"), bounds))
    least = df.groupBy("block").agg(F.min("at").alias("_least"))
    firsts = df.join(F.broadcast(least.select("_least")), F.col("at") == F.col("_least"))  # MOST_BLOCKS rows
    one = Window.partitionBy("block").orderBy("text")
    edges = written(firsts.withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n", "_least"), "firsts")
    lowest = edges.agg(F.min("block")).scalar()
    previous = F.when(F.col("block") == lowest, F.lit(len(bounds))).otherwise(F.col("block") - 1)
    return df.withColumn("edge", F.lit(False)).unionByName(edges.withColumns({"block": previous, "edge": F.lit(True)}))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, both fingerprints, ``near_edited`` and ``near_next``.

    The edited text has its last quarter replaced by the start of the next
    document's text. Texts are shuffled once, by block.
    """
    in_block = Window.partitionBy("block").orderBy("edge", "at", "text")
    rows = with_next(docs, doc_id, text).withColumns(
        {"n_chars": F.length("text").cast("bigint"), "_next": F.lead("text").over(in_block), "_place": F.row_number().over(in_block)}
    )
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter)
    taken = F.substring(F.coalesce("_next", F.lit("")), F.lit(1), quarter)
    rows = rows.select("block", "edge", "_place", "doc_id", "n_chars", "text", F.when(~F.col("edge"), F.concat(kept, taken)).alias("_edited"))
    rows = with_signature(rows, "text", "_own").drop("text")
    rows = rows.withColumn("edited_sha256", F.sha2("_edited", 256))
    rows = with_signature(rows, "_edited", "_other").drop("_edited")
    rows = rows.withColumn("_after", F.lead("_own").over(Window.partitionBy("block").orderBy("_place"))).filter(~F.col("edge"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("_own")).alias("fingerprint"), as_text(F.col("_other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"), likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )
