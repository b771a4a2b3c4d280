"""Writes. Nothing here overwrites a path that the frame being written still reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.windows import latest_per_key


def append_by_date(
    df: DataFrame, path: str, file_format: str = "parquet",
    by: tuple[str, ...] = ("year", "month", "day"), max_tasks: int | None = None,
) -> None:
    """Date-partitioned append.

    By default rows are rebalanced on the partition columns: small days share a
    task and a hot day is split over several. ``max_tasks`` bounds the number of
    output tasks instead (16 in the job this mirrors).
    """
    shaped = df.coalesce(max_tasks) if max_tasks else df.hint("rebalance", *by)
    shaped.write.partitionBy(*by).mode("append").format(file_format).save(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows of; the files of all others stay as they are.

    Partitions are staged and moved in at commit, so a failed job leaves the table as it was.
    Running it twice with the same rows changes nothing. An empty frame replaces nothing.
    """
    shaped = df.hint("rebalance", *by)
    shaped.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def partition_files(spark: SparkSession, path: str, by: str) -> DataFrame:
    """``by``, ``file`` and ``modified`` of each file of a partitioned table; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    value = F.regexp_extract("path", f"/{by}=([^/]*)/", 1)
    return files.select(value.alias(by), F.col("path").alias("file"), F.col("modificationTime").alias("modified"))


def overwrite_layer(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_single_csv(df: DataFrame, path: str) -> None:
    """One headerless CSV file; meant for aggregates that are small by construction."""
    df.coalesce(1).write.mode("overwrite").csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def copy_into(stage: DataFrame, columns: list[tuple[str, str, str]], table: str) -> None:
    """Bulk load: pick stage columns by position name, cast, append by name."""
    typed = stage.select(*[F.col(src).cast(kind).alias(dst) for src, kind, dst in columns])
    if stage.sparkSession.catalog.tableExists(table):
        typed.select(*stage.sparkSession.table(table).columns).write.mode("append").insertInto(table)
    else:
        typed.write.saveAsTable(table)


def create_or_replace(df: DataFrame, table: str) -> None:
    """Replace a table and its schema."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def insert_append(df: DataFrame, table: str) -> None:
    """Append by column name; running it twice doubles the rows."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=False)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace the rows, keep the table; running it twice changes nothing."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)


def truncate(spark: SparkSession, table: str) -> None:
    empty = spark.createDataFrame([], spark.table(table).schema)
    empty.write.insertInto(table, overwrite=True)


def split_write(df: DataFrame, flag: Column, passed_path: str, failed_path: str) -> None:
    """Rows where ``flag`` is true go to one path, all others (NULL too) to the other.

    The flagged rows are kept between the two writes, so the input runs once.
    """
    flagged = df.withColumn("_ok", F.coalesce(flag, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        flagged.filter("_ok").drop("_ok").write.mode("overwrite").json(passed_path)
        flagged.filter("NOT _ok").drop("_ok").write.mode("overwrite").json(failed_path)
    finally:
        flagged.unpersist()


def put_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Keyed put, write side: each batch owns one folder, so a replay replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_puts(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Keyed put, read side: the row of the latest batch wins for each key."""
    try:
        log = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return latest_per_key(log, keys, [F.desc("batch_id")]).drop("batch_id")


def compact_puts(spark: SparkSession, path: str, schema: str, keys: list[str], target: str) -> DataFrame:
    """Fold the batches into one new base table at ``target``."""
    return overwrite_layer(read_puts(spark, path, schema, keys), target)


def read_newest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the newest ``batch_id`` folder of JSON totals."""
    every = spark.read.schema(f"{schema}, batch_id bigint").option("basePath", path).json(path)
    newest = every.agg(F.max("batch_id")).scalar()
    return every.filter(F.col("batch_id") == newest).drop("batch_id")
