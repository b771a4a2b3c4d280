"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, html_text, language, lexical_search, license_scan, merkle, mixing, oracles, order_minhash, quality, sentencepiece, simhash, token_store, url_filter,
)
from tidemark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op6_chat_format": oracles.CHAT, "op7_mix_sources": oracles.MIX, "op8_quality_rules": oracles.QUALITY,
    "op11_license_scan": oracles.LICENSES, "op12_merkle_manifest": oracles.MERKLE, "op13_lexical_search": oracles.SEARCH,
}


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    return importlib.import_module("public_tokenizers").path(name)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = sentencepiece.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])
    return out.select("_row.doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "decoded")


@query
def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    out = html_text.extract(table(spark, folder, "pages"), keep=["page_id", "url"])
    return out.select("_row.page_id", "_row.url", "text", "n_chars", "path")


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    out = url_filter.judge(table(spark, folder, "pages"), keep=["page_id"])
    return out.select("_row.page_id", "host", "path", "rule", "verdict", "log_ratio")


@query
def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.store_and_read(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat.digests(chat.segments(turns.unionByName(added)))


@query
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    return out.select("_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality.judge(table(spark, folder, "documents"), keep=["doc_id"])
    return out.select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, folder, "documents"))


@query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    training = docs.filter(~held_out & F.col("lang").isNotNull())
    out = language.identify(docs, training, keep=["doc_id"]).select("_row.doc_id", "lang_pred", "score")
    return out.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    out = license_scan.scan(table(spark, folder, "documents"), keep=["doc_id"])
    return out.select("_row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.prove(table(spark, folder, "documents"))


@query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    index = lexical_search.build(table(spark, folder, "documents"))
    return lexical_search.search(index, table(spark, folder, "benchmark"))
