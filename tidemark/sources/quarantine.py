"""Loads that lose no record: what a declared schema refuses is kept and can be replayed."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.scans import envelope
from tidemark.sources.scratch import new_folder

ORIGIN = ("file", "split_start", "modified")


def load_or_quarantine(
    spark: SparkSession, path: str, schema: str, form: str, options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Typed records of ``json`` or ``csv`` files, and the refused ones with text and origin.

    A record is refused if it cannot be parsed, has a value of another type or,
    in CSV, another number of fields. The files are read once and written by
    verdict to the shared folder, so both frames are whole and agree, whatever
    happens to the source later. Blank lines are no records. ``record`` holds
    the text, ``file``, ``split_start`` (first byte of the split it was read
    in) and ``modified`` tell where it came from.
    """
    shape = StructType.fromDDL(f"{schema}, _corrupt string")
    reader = spark.read.format(form).schema(shape).options(**(options or {}), mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    origin = ("file_path", "file_block_start", "file_modification_time")
    rows = reader.load(path).select("*", *[F.col(f"_metadata.{m}").alias(f"_{name}") for m, name in zip(origin, ORIGIN)])
    judged = rows.withColumn("_refused", F.col("_corrupt").isNotNull())
    folder = new_folder(spark, "quarantine")
    judged.write.partitionBy("_refused").parquet(folder)
    kept = spark.read.schema(judged.schema).parquet(folder)
    fields = [f.name for f in shape.fields if f.name != "_corrupt"]
    refused = kept.filter("_refused").select(F.col("_corrupt").alias("record"), *[F.col(f"_{name}").alias(name) for name in ORIGIN])
    return kept.filter("NOT _refused").select(*fields), refused


def replay(refused: DataFrame, mend: Callable[[Column], Column], schema: str) -> tuple[DataFrame, DataFrame]:
    """Refused JSON records after ``mend``: those that now load, and those still refused, with their first text."""
    mended = refused.withColumn("_body", mend(F.col("record"))).withColumn("_given", F.col("_body").isNotNull())
    parsed = envelope(mended, schema, "_body")
    fields = StructType.fromDDL(schema).fieldNames()
    fine = F.col("corrupt").isNull() & F.col("_given")
    return parsed.filter(fine).select(*fields), parsed.filter(~fine).select(*refused.columns)
