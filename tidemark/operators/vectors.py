"""Vector search over query tables: exact, by tiles, and probed, by an inverted file of k-means cells.

Few queries, one block of them, travel packed and are joined to chunks of the vectors. More
queries and the vectors are dealt into groups, and each pair of groups is a tile: one task that
holds its queries and their ``k`` best so far while the vectors stream past, a batch of plain
rows at a time. A group has ``TILE_BYTES`` at most, so a task's memory does not grow with the
tables; a row is copied once per group of the other side. Neither side passes the driver.

Similarity is cosine. Vectors and queries of unlike length, or with a NULL, NaN or infinite
element, are no match. Equal scores stand by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import qualify
from tidemark.sources.scratch import new_folder, written

QUERY_BLOCK = 1024
CHUNK = 4096
MOST_CELLS = 4096
SAMPLE_ROWS = 100_000
TILE_BYTES = 1 << 25
ROWS_AT_ONCE, TIES_AT_ONCE = 1 << 16, 1 << 19

_CHUNKS = "ids array<bigint>, vectors array<{}>"
_FOUND = "query_id bigint, vec_id bigint, score double"


def finite(vector: str) -> Column:
    """Whether a vector is there and all its elements are finite numbers."""
    usual = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(F.col(vector), usual), F.lit(False))


def _rows(df: DataFrame, name: str, vector: str) -> DataFrame:
    """Usable vectors, as floats where they are floats and as doubles else."""
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    return df.filter(finite(vector)).select(F.col(name).cast("bigint").alias("id"), F.col(vector).cast(kind).alias("vector"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per ``CHUNK`` vectors, where the scan has them."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), column) for column in part.columns]
            yield pa.RecordBatch.from_arrays(lists, names=["ids", "vectors"])


def _by_width(ids: list, vectors: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors by length of the vector; a vector of length zero stays zero."""
    widths: dict[int, list[int]] = {}
    for k, v in enumerate(vectors):
        widths.setdefault(len(v), []).append(k)
    out = {}
    for width, places in widths.items():
        rows = np.array([vectors[k] for k in places], dtype=np.float64).reshape(len(places), width)
        length = np.linalg.norm(rows, axis=1, keepdims=True)
        out[width] = (np.array([ids[k] for k in places], dtype=np.int64), np.divide(rows, length, out=np.zeros_like(rows), where=length > 0))
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of each row's ``k`` best scores, equal ones by id."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        rows, columns = np.nonzero(scores >= least[:, None])
    else:
        rows, columns = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def _scored(k: int):
    """Task function over rows of ``ids``, ``vectors``, ``query_ids``, ``queries``: ``k`` rows per query and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, vectors, names, queries = (batch.column(c)[at].as_py() for c in range(4))
                asked = _by_width(names, queries)
                owners, found, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
                for width, (own, rows) in _by_width(ids, vectors).items():
                    if width in asked and width:
                        query_ids, units = asked[width]
                        product = units @ rows.T
                        r, c = best_of(product, own, k)
                        owners.append(query_ids[r])
                        found.append(own[c])
                        scores.append(product[r, c])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (owners, found, scores)], names=["query_id", "vec_id", "score"])

    return run


@dataclass
class _Asked:
    """Queries of one tile and of one length: unit vectors, cells to probe as bits, and the ``k`` best matches so far."""

    ids: np.ndarray
    units: np.ndarray
    probes: np.ndarray | None
    k: int
    scores: np.ndarray = field(init=False)
    found: np.ndarray = field(init=False)

    def __post_init__(self):
        self.scores = np.full((len(self.ids), self.k), -np.inf)
        self.found = np.full((len(self.ids), self.k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, units: np.ndarray, cell: int) -> None:
        """Match vectors of one cell with the queries that probe it."""
        if self.probes is None:
            asking = np.arange(len(self.ids))
        else:
            asking = np.flatnonzero(self.probes[:, (cell + 1) >> 3] >> ((cell + 1) & 7) & 1)
        for at in range(0, len(asking), QUERY_BLOCK):
            own = asking[at : at + QUERY_BLOCK]
            self._keep(own, ids, self.units[own] @ units.T)

    def _keep(self, own: np.ndarray, ids: np.ndarray, product: np.ndarray) -> None:
        kth, last = self.scores[own, -1], self.found[own, -1]
        least = kth
        if product.shape[1] > self.k and np.isneginf(kth).any():
            place = product.shape[1] - self.k
            least = np.maximum(kth, np.partition(product, place, axis=1)[:, place])
        near = product >= least[:, None]
        if len(own) > 1 and np.count_nonzero(near) > TIES_AT_ONCE:
            half = len(own) // 2
            self._keep(own[:half], ids, product[:half])
            self._keep(own[half:], ids, product[half:])
            return
        places = np.flatnonzero(near)
        rows, columns = np.divmod(places, product.shape[1])
        scores = product.ravel()[places]
        better = (scores > kth[rows]) | (ids[columns] < last[rows])  # of equal scores, only lesser ids
        rows, columns, scores = rows[better], columns[better], scores[better]
        touched = np.unique(rows)
        all_rows = np.concatenate([rows, np.repeat(touched, self.k)])
        all_scores = np.concatenate([scores, self.scores[own[touched]].ravel()])
        all_ids = np.concatenate([ids[columns], self.found[own[touched]].ravel()])
        order = np.lexsort((all_ids, -all_scores, all_rows))
        sorted_rows = all_rows[order]
        best = order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < self.k]
        self.scores[own[touched]] = all_scores[best].reshape(-1, self.k)
        self.found[own[touched]] = all_ids[best].reshape(-1, self.k)

    def matches(self) -> Iterator[pa.RecordBatch]:
        step = max(1, ROWS_AT_ONCE // self.k)
        for at in range(0, len(self.ids), step):
            scores, found = self.scores[at : at + step], self.found[at : at + step]
            rows, columns = np.nonzero(scores > -np.inf)
            values = self.ids[at : at + step][rows], found[rows, columns], scores[rows, columns]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], names=["query_id", "vec_id", "score"])


def _units(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors by length of the vector, without those of no length; a vector of length zero stays zero."""
    widths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()[:-1]
    for width in np.unique(widths[widths > 0]).tolist():
        places = np.flatnonzero(widths == width)
        rows = flat[starts[places][:, None] + np.arange(width)].astype(np.float64)
        length = np.linalg.norm(rows, axis=1, keepdims=True)
        yield places, np.divide(rows, length, out=rows, where=length > 0)


def _tile(k: int):
    """Task function over one tile after another, its queries before its vectors, these by cell."""

    def asked(parts: list[pa.RecordBatch]) -> dict[int, _Asked]:
        by_width: dict[int, list] = {}
        for part in parts:
            ids, probes = part.column("id").to_numpy(), part.column("probes")
            bits = None if probes.null_count else np.frombuffer(b"".join(probes.to_pylist()), np.uint8).reshape(len(ids), -1)
            for places, units in _units(part.column("vector")):
                by_width.setdefault(units.shape[1], []).append((ids[places], units, None if bits is None else bits[places]))
        out = {}
        for width in list(by_width):
            ids, units, bits = zip(*by_width.pop(width), strict=True)
            out[width] = _Asked(np.concatenate(ids), np.concatenate(units), None if bits[0] is None else np.concatenate(bits), k)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, parts, queries = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("tile", "kind", "cell")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                if keys[0, begin] != tile:
                    for own in (queries or {}).values():
                        yield from own.matches()
                    tile, parts, queries = keys[0, begin], [], None
                if not keys[1, begin]:
                    parts.append(batch.slice(begin, end - begin))
                    continue
                if queries is None:
                    queries, parts = asked(parts), []
                for at in range(begin, end, CHUNK):
                    some = batch.slice(at, min(CHUNK, end - at))
                    ids = some.column("id").to_numpy()
                    for places, units in _units(some.column("vector")):
                        if units.shape[1] in queries:
                            queries[units.shape[1]].meet(ids[places], units, int(keys[2, begin]))
        for own in (queries or {}).values():
            yield from own.matches()

    return run


def _groups(rows: int, least: int, row_bytes: int, spark: SparkSession) -> int:
    """Groups of ``TILE_BYTES`` at most; of larger tables, enough for all cores to have tiles."""
    most = max(1, TILE_BYTES // max(1, row_bytes))
    return max(1, -(-rows // most), min(-(-rows // least), math.isqrt(2 * spark.sparkContext.defaultParallelism) + 1))


def _row_bytes(df: DataFrame) -> int:
    width = df.agg(F.max(F.size("vector"))).first()[0] or 1
    return width * (4 if df.schema["vector"].dataType.elementType.simpleString() == "float" else 8)


def _met(rows: DataFrame, asked: DataFrame, blocks: int, groups: int, k: int) -> DataFrame:
    """Best matches per tile. ``rows`` have ``id``, ``vector``, ``cell`` and ``_group``, ``asked`` has ``id``, ``vector``, ``probes`` and ``_groups``."""
    same = "vector" if rows.schema["vector"].dataType == asked.schema["vector"].dataType else F.col("vector").cast("array<double>").alias("vector")
    deal = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))
    of_asked = asked.select(F.lit(0).alias("kind"), "id", same, F.lit(-2).alias("cell"), "probes", deal.alias("_block"), F.explode("_groups").alias("_group"))
    of_rows = rows.select(
        F.lit(1).alias("kind"), "id", same, "cell", F.lit(None).cast("binary").alias("probes"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), "_group",
    )
    tile = (F.col("_group") * blocks + F.col("_block")).cast("int")
    both = of_asked.unionByName(of_rows).select(tile.alias("tile"), "kind", "cell", "id", "vector", "probes")
    dealt = both.repartitionById(blocks * groups, "tile").sortWithinPartitions("tile", "kind", "cell")
    return _ranked(dealt.mapInArrow(_tile(k), _FOUND), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return qualify(found, rank, k)


def vector_topk(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    query_id: str = "query_id", query_col: str = "query", where: Column | None = None,
) -> DataFrame:
    """Exact cosine top-k for every query vector.

    Queries are written once. Up to ``QUERY_BLOCK`` of them are one packed row, and vectors are
    scanned once; more are met tile by tile, with the vectors written once too. ``where``
    restricts the vectors, for instance to a namespace.
    """
    spark = vectors.sparkSession
    asked = written(_rows(queries, query_id, query_col), "queries")
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], _FOUND)
    searched = _rows(vectors if where is None else vectors.filter(where), id_col, vector_col)
    if n_asked > QUERY_BLOCK:
        searched = written(searched, "vectors")
        row_bytes = _row_bytes(asked)
        groups, blocks = _groups(searched.count(), CHUNK, row_bytes, spark), _groups(n_asked, QUERY_BLOCK, row_bytes, spark)
        rows = searched.select("id", "vector", F.lit(-1).alias("cell"), F.pmod(F.xxhash64("id", "vector"), F.lit(groups)).alias("_group"))
        everywhere = F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")
        return _met(rows, asked.withColumns({"probes": F.lit(None).cast("binary"), "_groups": everywhere}), blocks, groups, k)
    doubles = lambda df: df.withColumn("vector", F.col("vector").cast("array<double>"))
    packed = doubles(asked).agg(F.collect_list(F.struct("id", "vector")).alias("q"))
    packed = written(packed.select(F.lit(0).alias("_block"), F.col("q.id").alias("query_ids"), F.col("q.vector").alias("queries")), "query-blocks")
    # A literal would be folded, and the equality join with it.
    chunks = doubles(searched).mapInArrow(_pack, _CHUNKS.format("array<double>")).select("*", F.explode(F.sequence(F.lit(0), F.lit(0))).alias("_of"))
    met = chunks.join(packed, F.col("_of") == F.col("_block")).select("ids", "vectors", "query_ids", "queries")
    return _ranked(met.mapInArrow(_scored(k), _FOUND), k)


@dataclass(frozen=True)
class CellIndex:
    """Vectors by cell, in a table partitioned by ``cell``, and the centres of the cells."""

    table: DataFrame
    centres: list[list[float]]


def build_cells(
    vectors: DataFrame, cells: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, seed: int = 7,
) -> CellIndex:
    """Inverted file: every vector under its nearest centre.

    Centres are fitted by k-means on the ``sample_rows`` vectors with the least hash of
    their id; every vector is filed. ``cells`` is the square root of the number of vectors
    by default, ``MOST_CELLS`` at most. A cell is cut into chunks of about ``CHUNK`` vectors
    by hash, so a hot cell is many rows of the table.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = written(_rows(vectors, id_col, vector_col), "vectors")
    kind = rows.schema["vector"].dataType.simpleString()
    total = rows.count()
    spark = vectors.sparkSession
    path = new_folder(spark, "cells")
    schema = f"{_CHUNKS.format(kind)}, cell int"
    if not total:
        return CellIndex(spark.createDataFrame([], schema), [])
    cells = cells or max(1, min(MOST_CELLS, round(total**0.5)))
    sample = rows.withColumn("_h", F.xxhash64("id", F.lit(seed)))
    if total > sample_rows:
        last = sample.select("_h").orderBy("_h").limit(sample_rows).agg(F.max("_h")).scalar()
        sample = sample.filter(F.col("_h") <= last)
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()[0]
    nonzero = F.exists("vector", lambda x: x != 0)
    fitted = sample.filter((F.size("vector") == usual) & nonzero).select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(fitted) if fitted.take(1) else None
    centres = [c.tolist() for c in model.clusterCenters()] if model else []

    filed = rows.mapInArrow(_nearest(centres), f"id bigint, vector {kind}, cell int")
    filed = written(filed, "filed")
    sizes = filed.groupBy(F.col("cell").alias("_cell")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_chunks"))
    chunk = F.pmod(F.xxhash64("id"), F.col("_chunks")).alias("_chunk")
    cut = filed.join(sizes, F.col("cell") == F.col("_cell")).select("cell", chunk, F.struct("id", "vector").alias("_v"))
    packed = cut.groupBy("cell", "_chunk").agg(F.collect_list("_v").alias("_all"))
    packed.select(F.col("_all.id").alias("ids"), F.col("_all.vector").alias("vectors"), "cell").write.partitionBy("cell").parquet(path)
    return CellIndex(spark.read.schema(schema).parquet(path), centres)


def _near(vectors: pa.ListArray, table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that have the centres' length, and the ``n`` nearest cells of each."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == table.shape[1]) if table.size else np.empty(0, np.int64)
    if not len(fits):
        return fits, np.empty((0, n), np.int64)
    starts, flat = vectors.offsets.to_numpy()[:-1][fits], vectors.values.to_numpy(zero_copy_only=False)
    rows = flat[starts[:, None] + np.arange(table.shape[1])].astype(np.float64)
    return fits, np.argsort(-(rows @ table.T), axis=1, kind="stable")[:, :n]


def _nearest(centres: list[list[float]]):
    """Task function: each row with its nearest cell; rows of another length go to cell -1."""
    table = np.array(centres, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.full(batch.num_rows, -1, np.int32)
            fits, near = _near(batch.column(1), table, 1)
            cells[fits] = near[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells)], names=["id", "vector", "cell"])

    return run


def _probing(centres: list[list[float]], n: int):
    """Task function: each row with its ``n`` nearest cells as bits; bit 0 is cell -1, where rows of another length look."""
    table = np.array(centres, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                asks = np.zeros((part.num_rows, len(centres) + 1), bool)
                fits, near = _near(part.column(1), table, n)
                asks[:, 0] = True
                asks[fits, 0] = False
                asks[fits[:, None], near + 1] = True
                bits = np.packbits(asks, axis=1, bitorder="little")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x.tobytes() for x in bits], pa.binary())], names=["id", "vector", "probes"])

    return run


def _bits(probes: pa.Array, n: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(probes.to_pylist()), np.uint8).reshape(len(probes), -1)
    return np.unpackbits(rows, axis=1, count=n, bitorder="little").astype(bool)


def _probed(n: int):
    """Task function: the cells that any row probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        any_ = np.zeros(n, bool)
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                any_ |= _bits(batch.column(0).slice(at, QUERY_BLOCK), n).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array((np.flatnonzero(any_) - 1).astype(np.int32))], names=["cell"])

    return run


def _asked_groups(lies: np.ndarray):
    """Task function: each row with the groups that its cells lie in; ``lies`` has a row per cell and a column per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                meets = (_bits(part.column(2), len(lies)).astype(np.float32) @ lies) > 0
                ends = np.cumsum([0, *meets.sum(axis=1)], dtype=np.int32)
                groups = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(meets)[1].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, groups], names=["id", "vector", "probes", "_groups"])

    return run


def search_cells(
    index: CellIndex, queries: DataFrame, k: int, probes: int, query_id: str = "query_id", query_col: str = "query",
) -> DataFrame:
    """Cosine top-k for every query among the vectors of its ``probes`` nearest cells.

    A query keeps its cells as bits and goes once to each group of vectors in which one of them
    lies, not once to each cell. The cells lie one after another on a line that is cut into
    groups, so a hot cell is in several. Only cells that are asked for are read. With as many
    probes as cells the result is exact.
    """
    spark, n = index.table.sparkSession, len(index.centres) + 1
    asked = _rows(queries, query_id, query_col)
    kind = asked.schema["vector"].dataType.simpleString()
    asked = written(asked.mapInArrow(_probing(index.centres, probes), f"id bigint, vector {kind}, probes binary"), "probes")
    cells = [r.cell for r in asked.select("probes").mapInArrow(_probed(n), "cell int").distinct().collect()]
    table = index.table.filter(F.col("cell").isin(cells)) if len(cells) < n else index.table
    sizes = {r.cell: r.n for r in table.groupBy("cell").agg(F.sum(F.size("ids")).alias("n")).collect()} if cells else {}
    if not sizes:
        return spark.createDataFrame([], _FOUND)
    total, row_bytes = sum(sizes.values()), _row_bytes(asked)
    groups, blocks = _groups(total, CHUNK, row_bytes, spark), _groups(asked.count(), QUERY_BLOCK, row_bytes, spark)
    length, at, lies, line = -(-total // groups), 0, np.zeros((n, groups), np.float32), []
    for cell, size in sorted(sizes.items()):
        lies[cell + 1, at // length : (at + size - 1) // length + 1] = 1
        line.append((cell, at, size))
        at += size
    line = written(spark.createDataFrame(line, "_cell int, _at bigint, _size bigint"), "cells")
    rows = table.join(line, F.col("cell") == F.col("_cell")).select("cell", "_at", "_size", F.explode(F.arrays_zip("ids", "vectors")).alias("v"))
    rows = rows.select(F.col("v.ids").alias("id"), F.col("v.vectors").alias("vector"), "cell", "_at", "_size")
    place = F.col("_at") + F.pmod(F.xxhash64("id", "vector"), F.col("_size"))
    rows = rows.select("id", "vector", "cell", F.floor(place / length).alias("_group"))
    asked = asked.mapInArrow(_asked_groups(lies), f"id bigint, vector {kind}, probes binary, _groups array<bigint>")
    return _met(rows, asked, blocks, groups, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``queries``, ``wanted`` and ``hit``: how many exact matches the probed search found too."""
    mine = found.select(F.col("query_id").alias("_q"), F.col("vec_id").alias("_v"), F.lit(1).alias("_hit"))
    both = exact.join(mine, (F.col("query_id") == F.col("_q")) & (F.col("vec_id") == F.col("_v")), "left")
    per_query = both.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("_hit").alias("hit"))
    return per_query.agg(F.count("*").alias("queries"), F.sum("wanted").alias("wanted"), F.sum("hit").alias("hit"))


def with_metadata(found: DataFrame, vectors: DataFrame, columns: Sequence[str], id_col: str = "vec_id") -> DataFrame:
    """Matches with stored columns of their vectors."""
    return found.join(vectors.select(F.col(id_col).alias("vec_id"), *columns), "vec_id")
