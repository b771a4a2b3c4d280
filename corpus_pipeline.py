"""From raw documents to encoded, mixed training text, in five stages.

Each stage reads what the one before it wrote as Parquet in the shared storage. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, quality, sentencepiece, simhash
from tidemark.llm.queries import tokenizer_file
from tidemark.sources.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the adaptive limits reject."""
    return quality.judge(docs).filter("kept").select("_row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language that the labelled rows teach; ``lang`` stays as it was."""
    labelled = docs.filter(F.col("lang").isNotNull())
    found = language.with_limits(language.identify(docs, labelled))
    return found.filter((F.col("lang_pred") != "und") & (F.col("known") >= F.col("known_least"))).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near duplicates."""
    return simhash.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``documents`` with the piece ids of each text, which the operator also decodes again."""
    out = sentencepiece.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"))
    return out.select("_row.*", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode),
]

#: SimHash and Viterbi have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
