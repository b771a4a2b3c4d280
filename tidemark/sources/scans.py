"""File, stage and catalog scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Separators tried by discovery, most common first.
SEPARATORS = (",", "|", "\t", ";")


def from_files(
    spark: SparkSession, folder: str, pattern: str, file_format: str,
    schema: StructType | str | None = None,
) -> DataFrame:
    """All files of ``folder`` that match ``pattern`` (callers pass e.g. ``2021-01-13-*``)."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{folder}/{pattern}")


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv_with_header(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def stage_options(separator: str = ",") -> dict[str, str]:
    """Stage file form: one header line, trimmed fields, optional double quotes."""
    return {
        "sep": separator,
        "header": "true",
        "quote": '"',
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "enforceSchema": "true",
    }


def stage_schema(columns: int) -> str:
    return ", ".join(f"c{i} string" for i in range(1, columns + 1))


def stage_files(spark: SparkSession, path: str, columns: int, separator: str = ",") -> DataFrame:
    """Untyped stage files addressed by position as ``c1 .. cn``."""
    return spark.read.schema(stage_schema(columns)).options(**stage_options(separator)).csv(path)


def catalog_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.read.table(f"`{database}`.`{name}`")


def file_separators(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and the ``separator`` that splits most of its lines into the same number of fields, two at least.

    Every line counts. Quoted parts are taken out first; fields are counted per
    file, separator and count, before the shuffle and after it. Of equal shares
    the larger count wins, then the order of ``SEPARATORS``.
    """
    bare = F.regexp_replace("value", '"[^"]*"', "")
    fields = lambda s: F.length(bare) - F.length(F.replace(bare, F.lit(s), F.lit(""))) + 1
    options = F.array(
        *[F.struct(F.lit(-i).alias("rank"), F.lit(s).alias("separator"), fields(s).alias("fields")) for i, s in enumerate(SEPARATORS)]
    )
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    split = lines.select(F.col("_metadata.file_path").alias("file"), F.explode(options).alias("o"))
    counts = split.groupBy("file", "o").agg(F.count("*").alias("n"))
    score = F.struct(F.when(F.col("o.fields") > 1, F.col("n")).otherwise(0), "o.fields", "o.rank")
    return counts.groupBy("file").agg(F.max_by("o.separator", score).alias("separator"))


def discovered_files(spark: SparkSession, path: str) -> DataFrame:
    """Delimited files whose separators and column types are found from the data.

    Each file has its own separator. Files with the same one are read together,
    and the groups are joined by column name. One row per file reaches the driver,
    which lists the files anyway.
    """
    files: dict[str, list[str]] = {}
    for row in file_separators(spark, path).collect():
        files.setdefault(row.separator, []).append(row.file)
    out = None
    for separator in sorted(files, key=SEPARATORS.index):
        options = {**stage_options(separator), "enforceSchema": "false", "inferSchema": "true"}
        part = spark.read.options(**options).csv(sorted(files[separator]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], StructType()) if out is None else out


def stage_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file under a prefix; file contents are pruned from the scan."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )


def envelope(bodies: DataFrame, schema: str, body: str = "body") -> DataFrame:
    """Decode a JSON ``body`` column; undecodable bodies keep their text in ``corrupt``."""
    shape = StructType.fromDDL(f"{schema}, corrupt string")
    parsed = F.from_json(body, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return bodies.withColumn("_m", parsed).select(
        *[c for c in bodies.columns if c != body],
        *[
            F.when(F.col("_m").isNull(), F.col(body)).otherwise(F.col("_m.corrupt")).alias("corrupt")
            if f.name == "corrupt"
            else F.col(f"_m.{f.name}").alias(f.name)
            for f in shape.fields
        ],
    )


COLUMN_METADATA = "table_name string, position int, column_name string, data_type string, description string"


def column_metadata(
    spark: SparkSession,
    tables: Iterable[str],
    fallback: Mapping[str, list[Mapping[str, str]]] | None = None,
) -> DataFrame:
    """Columns per table in ordinal order, partition columns last.

    ``fallback`` holds catalog columns (name, type, description): they describe
    live columns and stand in for a table that does not exist. Tables with
    neither are left out.
    """
    known = fallback or {}
    rows = []
    for name in tables:
        documented = {c["name"]: c for c in known.get(name, [])}
        if spark.catalog.tableExists(name):
            live = spark.catalog.listColumns(name)
            ordered = [c for c in live if not c.isPartition] + [c for c in live if c.isPartition]
            columns = [(c.name, c.dataType, documented.get(c.name, {}).get("description")) for c in ordered]
        else:
            columns = [(c["name"], c.get("type"), c.get("description")) for c in known.get(name, [])]
        rows += [(name, i, *column) for i, column in enumerate(columns, start=1)]
    return spark.createDataFrame(rows, COLUMN_METADATA)
