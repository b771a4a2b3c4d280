"""File-based stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scans import stage_options, stage_schema

_PARSE = {"mode": "PERMISSIVE"}


def record_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records whose JSON payload is one text line each."""
    lines = spark.readStream.text(path)
    return lines.select(F.from_json("value", schema, _PARSE).alias("r")).select("r.*")


def document_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array."""
    return spark.readStream.schema(schema).option("multiLine", True).json(path)


def message_stream(spark: SparkSession, path: str) -> DataFrame:
    """Queue envelopes ``{"body": "<json>"}``; ``arrived`` orders them by file time, file and block of the file."""
    messages = spark.readStream.schema("body string").json(path)
    place = [F.col(f"_metadata.{name}") for name in ("file_modification_time", "file_path", "file_block_start")]
    return messages.select("body", F.struct(*place).alias("arrived"))


def stage_stream(spark: SparkSession, path: str, columns: int, separator: str = ",") -> DataFrame:
    return spark.readStream.schema(stage_schema(columns)).options(**stage_options(separator)).csv(path)
