"""Merkle manifest of a dataset, with proofs that resume copied SHA-256 states.

A leaf is the digest of a row's fields, each with its length. Per group (a language)
leaves stand in id order; runs of ``FAN`` nodes become their parent until one is left,
the subroot; subroots, in group order, become the root the same way.

Trees are worked on in *bundles* of ``FAN ** LEVELS`` (4096) neighbouring nodes: one
shuffle of digests lifts a whole table by ``LEVELS`` levels. A task holds the digests of
one bundle and no texts, however large its group. What a bundle needs to know of
the levels above it is one row: at each level the siblings left and right of its node.

For the proofs, each parent keeps a copy of its hash state before each child slot. A
changed leaf is folded by resuming the copy before its own slot with its new digest and
the siblings to the right; siblings to the left are never hashed again. Levels above
a bundle keep one such state each, for all its leaves.

Defined results: null fields are ``-``; a null group comes first, null ids come first
in their group, and repeated ids stand in the order of their leaves; a lone leaf is its
subroot; an empty table has no row and no root. A row without an id is not tampered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_rows
from tidemark.sources.scratch import written

FAN, LEVELS = 8, 4
BUNDLE_BITS = 12  # FAN ** LEVELS nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(text.rlike("[A-Z]"), F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)


def tampered_with(doc_id: Column) -> Column:
    """Whether 3 divides the CRC-32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _runs(nodes: list[str]) -> list[list[str]]:
    return [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)]


def _lift(nodes: list[str], levels: int) -> str:
    """The node ``levels`` above these, which share it."""
    for _ in range(levels):
        nodes = [digest(*run) for run in _runs(nodes)]
    (top,) = nodes
    return top


def _depth(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    depth = 0
    while n > 1:
        n, depth = -(-n // FAN), depth + 1
    return depth


def _lifted(table: pa.Table) -> pa.Table:
    rows = table.sort_by("place")
    size, group, place = (rows.column(c)[0].as_py() for c in ("size", "group", "place"))
    top = _lift(rows.column("node").to_pylist(), min(LEVELS, _depth(size)))
    return pa.table({"group": [group], "place": [place >> BUNDLE_BITS], "size": [-(-size >> BUNDLE_BITS)], "node": [top]}, schema=_NODES)


_NODES = pa.schema([("group", pa.int64()), ("place", pa.int64()), ("size", pa.int64()), ("node", pa.string())])
_NODE_COLUMNS = "group bigint, place bigint, size bigint, node string"
_STEPS = "array<struct<left:string,right:string>>"


def _steps_of(table: pa.Table) -> pa.Table:
    """For each node of a bundle its steps: at each level what stands left and right of it in its run."""
    rows = table.sort_by("place")
    size, place = rows.column("size")[0].as_py(), rows.column("place").to_pylist()
    nodes = rows.column("node").to_pylist()
    at = [p & ((1 << BUNDLE_BITS) - 1) for p in place]
    steps: list[list[dict]] = [[] for _ in at]
    for _ in range(min(LEVELS, _depth(size))):
        for k, p in enumerate(at):
            start = p - p % FAN
            steps[k].append({"left": "".join(nodes[start:p]), "right": "".join(nodes[p + 1 : start + FAN])})
        nodes, at = [digest(*run) for run in _runs(nodes)], [p // FAN for p in at]
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"group": rows.column("group"), "place": rows.column("place"), "steps": pa.array(steps, kind)})


def _lift_all(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """``nodes`` and the tables above it, each ``LEVELS`` levels up and written, until every group has one node."""
    tiers = [nodes]
    while largest > 1:
        bundle = [F.col("group"), F.shiftright("place", BUNDLE_BITS).alias("bundle")]
        tiers.append(written(tiers[-1].groupBy(*bundle).applyInArrow(_lifted, _NODE_COLUMNS), "nodes"))
        largest = -(-largest >> BUNDLE_BITS)
    return tiers


def _steps_above(tiers: list[DataFrame]) -> DataFrame:
    """``group``, ``place`` and ``steps`` to the top for each node of the lowest tier given."""
    top = tiers[-1].select("group", "place", F.array().cast(_STEPS).alias("steps"))
    for tier in reversed(tiers[:-1]):
        bundle = [F.col("group"), F.shiftright("place", BUNDLE_BITS).alias("bundle")]
        own = tier.groupBy(*bundle).applyInArrow(_steps_of, f"group bigint, place bigint, steps {_STEPS}")
        above = top.select(F.col("group").alias("_group"), F.col("place").alias("_place"), F.col("steps").alias("_above"))
        joined = own.join(above, (F.col("group") == F.col("_group")) & (F.shiftright("place", BUNDLE_BITS) == F.col("_place")))
        top = joined.select("group", "place", F.concat("steps", "_above").alias("steps"))
    return top


class Parent:
    """A node with copies of its hash state before each child slot."""

    def __init__(self, children: list[str]):
        self.states, self.children = [], children
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.node = state.hexdigest()

    def fold(self, slot: int, node: str) -> str:
        """The parent's digest with ``node`` in ``slot``, from the state before it and the siblings to its right."""
        state = self.states[slot].copy()
        state.update((node + "".join(self.children[slot + 1 :])).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(self.children[:slot] + self.children[slot + 1 :])


def _prove(rows: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and folded root of each leaf of one bundle; ``above`` is the one row about the levels over it."""
    rows = rows.sort_by("place")
    size = rows.column("size")[0].as_py()
    (steps,), (subroot,), (root,) = (above.column(c).to_pylist() for c in ("steps", "subroot", "root"))
    nodes = rows.column("node").to_pylist()
    at = [p & ((1 << BUNDLE_BITS) - 1) for p in rows.column("place").to_pylist()]
    folded, proofs = rows.column("folded").to_pylist(), [hashlib.sha256() for _ in at]
    for _ in range(min(LEVELS, _depth(size))):
        parents = [Parent(run) for run in _runs(nodes)]
        for k, p in enumerate(at):
            parent, slot = parents[p // FAN], p % FAN
            proofs[k].update(parent.siblings(slot).encode())
            folded[k] = parent.fold(slot, folded[k])
            at[k] = p // FAN
        nodes = [p.node for p in parents]
    siblings = "".join(s["left"] + s["right"] for s in steps).encode()
    resumed = [(hashlib.sha256(s["left"].encode()), s["right"].encode()) for s in steps]
    known: dict[str, str] = {}
    for k, node in enumerate(folded):
        proofs[k].update(siblings)
        if node not in known:
            top = node
            for state, right in resumed:
                state = state.copy()
                state.update(top.encode() + right)
                top = state.hexdigest()
            known[node] = top
        folded[k] = known[node]
    return pa.table(
        {
            "id": rows.column("id"), "leaf": rows.column("node"), "subroot": pa.array([subroot] * len(at), pa.string()),
            "root": pa.array([root] * len(at), pa.string()), "proof_sha256": pa.array([p.hexdigest() for p in proofs], pa.string()),
            "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_()),
        }
    )


def manifest(rows: DataFrame, group: str, order: str, leaf: str, changed: str | None = None) -> DataFrame:
    """Leaves and their trees: ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` per row.

    ``leaf`` is the digest of a row and ``changed`` the digest to fold in its place (its
    own by default). Rows are ranged by group and id, which splits a large group over
    tasks, and numbered from the sizes of the ranges.
    """
    changed = changed or leaf
    columns = [F.col(group).alias("_name"), F.col(order).alias("id"), F.col(leaf).alias("node"), F.col(changed).alias("folded")]
    # equal rows may stand in any order; the number of the row, once written, lets ranges split them
    leaves = written(rows.select(*columns, F.monotonically_increasing_id().alias("_tie")), "leaves")
    placed = number_rows(leaves, "_pos", ["_name", "id", "node", "_tie"], start=0)
    groups = placed.groupBy("_name").agg(F.min("_pos").alias("_first"), F.count("*").alias("size"))
    groups = number_rows(groups, "_number", ["_name"], start=0)
    largest, n_groups = groups.agg(F.max("size"), F.count("*")).first()
    named = groups.select(F.col("_name").alias("_of"), "_first", "size", F.col("_number").alias("group"))
    numbered = placed.join(named, F.col("_name").eqNullSafe(F.col("_of")))
    numbered = written(numbered.select("id", "node", "folded", "size", "group", (F.col("_pos") - F.col("_first")).alias("place")), "numbered")

    tiers = _lift_all(numbered.select("group", "place", "size", "node"), largest or 0)
    subroots = tiers[-1].select(F.lit(0).cast("bigint").alias("group"), F.col("group").alias("place"), F.lit(n_groups).cast("bigint").alias("size"), "node")
    roots = _lift_all(subroots, n_groups)
    final = roots[-1].select(F.lit(0).alias("_one"), F.col("node").alias("root")).limit(1)
    over = _steps_above(roots).select(F.col("place").alias("_number"), F.col("steps").alias("_over"), F.lit(0).alias("_all"))
    over = over.join(subroots.select(F.col("place").alias("_sub"), F.col("node").alias("subroot")), F.col("_number") == F.col("_sub"))
    over = over.join(final, F.col("_all") == F.col("_one"))

    # a tree of one leaf has no tier above; its bundle is the leaf itself
    upper = tiers[1:] or [numbered.select("group", F.lit(0).cast("bigint").alias("place"), "size", "node")]
    path = _steps_above(upper).join(over, F.col("group") == F.col("_number"))
    path = path.select("group", F.col("place").alias("bundle"), F.concat("steps", "_over").alias("steps"), "subroot", "root")
    bundled = numbered.withColumn("bundle", F.shiftright("place", BUNDLE_BITS))
    kind = dict(numbered.dtypes)["id"]
    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return bundled.groupBy("group", "bundle").cogroup(written(path, "paths").groupBy("group", "bundle")).applyInArrow(_prove, schema)


def prove(docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", group: str = "lang", text: str = "text") -> DataFrame:
    """The manifest of ``docs`` with one tampering: where 3 divides the CRC-32 of the id, A-Z of the text are lower-cased."""
    own = leaf_of([F.col(c) for c in fields])
    other = leaf_of([ascii_lower(F.col(c)) if c == text else F.col(c) for c in fields])
    rows = docs.select(
        F.col(group).alias("_group"), F.col(doc_id).alias("_id"), own.alias("_leaf"),
        F.when(tampered_with(F.col(doc_id)), other).otherwise(own).alias("_changed"),
    )
    return manifest(rows, "_group", "_id", "_leaf", "_changed").withColumnRenamed("id", doc_id)
