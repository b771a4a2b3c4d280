"""Batch file job: read a pattern, add date parts, append partitioned files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.columns import with_date_parts
from tidemark.sources.scans import from_files
from tidemark.sources.sinks import append_by_date


def run(
    spark: SparkSession, source: str, prefix: str, source_format: str, target: str, target_format: str,
    schema: str | None = None, max_tasks: int | None = None,
) -> None:
    """``prefix`` is completed with ``-*``, so one run takes all files of one prefix."""
    rows = from_files(spark, source, f"{prefix}-*", source_format, schema)
    append_by_date(with_date_parts(rows), target, target_format, max_tasks=max_tasks)
