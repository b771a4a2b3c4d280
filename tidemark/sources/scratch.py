"""Shared scratch storage for results that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every node can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh folder below one folder per application, which can go when the application ends."""
    owner = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{owner}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, rows_in_file: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder, with ``rows_in_file`` rows to a file at most if given, and read it back.

    Cuts the lineage with a columnar copy, so later passes prune columns and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.option("maxRecordsPerFile", rows_in_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
