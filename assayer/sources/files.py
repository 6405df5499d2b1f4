"""File scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assayer.operators.schema import spark_type

# The formats a file source may name. Avro needs Spark's external package.
FORMATS = ("csv", "parquet", "json", "orc", "avro", "text", "xml")
CORRUPT = "_corrupt_record"


def declared_struct(columns: Sequence[Mapping[str, Any]]) -> T.StructType:
    """Read schema from declared columns with ``name``, ``type`` and ``required``."""
    return T.StructType([T.StructField(c["name"], spark_type(c["type"]), not c.get("required", False)) for c in columns])


def read_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str,
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan files; every option reaches the reader."""
    if file_format not in FORMATS:
        raise ValueError(f"unsupported file format {file_format!r}")
    reader = spark.read.format(file_format).options(**{k: str(v) for k, v in (options or {}).items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_declared_csv(
    spark: SparkSession, path: str, columns: Sequence[Mapping[str, Any]], options: Mapping[str, Any] | None = None
) -> DataFrame:
    """CSV with a declared schema; lines that do not fit keep their text in ``_corrupt_record``."""
    schema = declared_struct(columns).add(CORRUPT, T.StringType())
    settings = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    return read_files(spark, path, "csv", settings, schema)


def read_dir(spark: SparkSession, path: str, file_format: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """The files of one extension directly inside a folder."""
    settings = {"pathGlobFilter": f"*.{file_format}", "recursiveFileLookup": "false", **options}
    return read_files(spark, path, file_format, settings, schema)


def read_parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose columns differ, with the union of their columns."""
    return read_files(spark, path, "parquet", {"mergeSchema": "true"})
