"""Keyword search, neighbours of one vector, and relations between table schemas."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import latest_per_key


def query_tokens(text: str) -> list[str]:
    return sorted(set(text.lower().split()))


def searchable(*parts: Column) -> Column:
    """Lower-cased text of several columns, arrays joined by blanks, NULL as empty."""
    return F.lower(F.concat_ws(" ", *parts))


def keyword_search(df: DataFrame, text: Column, query: str, tie_break: Sequence[str], k: int | None = 10) -> DataFrame:
    """Rows holding at least one query token, best share of tokens first.

    A token counts when it occurs anywhere in the text. Tokens are literals, so
    the whole search is one projected scan and a top-k, without a join.
    """
    tokens = query_tokens(query)
    if not tokens:
        return df.withColumn("score", F.lit(0.0)).limit(0)
    hits = F.lit(0)
    for token in tokens:
        hits = hits + F.when(F.contains(F.col("_text"), F.lit(token)), 1).otherwise(0)
    ranked = (
        df.withColumn("_text", text)
        .withColumn("score", hits / F.lit(len(tokens)))
        .drop("_text")
        .orderBy(F.desc("score"), *tie_break)
    )
    # Filtering after the cut scores each text once; rows without a hit rank last anyway.
    return (ranked.limit(k) if k is not None else ranked).filter("score > 0")


def catalog_text() -> Column:
    """Searchable text of a table-catalog row."""
    return searchable(
        F.col("name"), F.col("description"), F.col("tags"), F.transform("columns", lambda c: c["name"])
    )


def vector_topk_approximate(
    vectors: DataFrame, query: Sequence[float], k: int, id_col: str = "vec_id",
    vector_col: str = "embedding", bucket_length: float = 0.5, tables: int = 8, seed: int = 7,
) -> DataFrame:
    """Approximate neighbours of one vector with Spark ML's random projections.

    Works on unit vectors, where Euclidean distance d and cosine c obey
    c = 1 - d*d/2.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    raw = vectors.select(id_col, array_to_vector(F.col(vector_col)).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="unit").transform(raw).drop("raw")
    model = BucketedRandomProjectionLSH(
        inputCol="unit", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(unit)
    key = np.asarray(query, dtype=np.float64) / (np.linalg.norm(query) or 1.0)
    near = model.approxNearestNeighbors(unit, Vectors.dense(key), k, distCol="distance")
    return near.select(id_col, (1.0 - F.col("distance") * F.col("distance") / 2.0).alias("score"))


def shared_columns(columns: DataFrame) -> DataFrame:
    """Columns each pair of tables has in common, from ``(table_name, column_name)`` rows.

    Input is metadata: one row per column of the catalog.
    """
    c = columns.select("table_name", "column_name").distinct()
    other = c.select(F.col("table_name").alias("other_table"), "column_name")
    return (
        c.join(other, "column_name")
        .filter("table_name < other_table")
        .groupBy("table_name", "other_table")
        .agg(F.sort_array(F.collect_set("column_name")).alias("shared"))
    )


def likely_versions(columns: DataFrame, overlap: float = 0.8) -> DataFrame:
    """Table pairs sharing more than ``overlap`` of their columns (of the smaller table)."""
    sizes = columns.groupBy("table_name").agg(F.count_distinct("column_name").alias("n"))
    other = sizes.select(F.col("table_name").alias("other_table"), F.col("n").alias("other_n"))
    pairs = shared_columns(columns).join(sizes, "table_name").join(other, "other_table")
    share = F.size("shared") / F.least("n", "other_n")
    return pairs.withColumn("overlap", share).filter(share > overlap).drop("n", "other_n")


def merged_candidates(candidates: DataFrame) -> DataFrame:
    """One candidate per table: ``db.name`` and ``name`` are one, richest metadata wins."""
    named = candidates.withColumn("table_key", F.element_at(F.split(F.lower("name"), r"\."), -1))
    width = F.coalesce(F.size("columns"), F.lit(0))
    return latest_per_key(named, ["table_key"], [width.desc(), F.asc("source"), F.asc("name")])
