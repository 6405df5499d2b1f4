"""Landed responses of remote interfaces: text payloads to rows.

A landing table has one row per response page: ``source``, ``page`` and ``payload``. Payloads are
read by expressions, file by file, in parallel; the paging rule is an aggregate per source.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.payload import is_json_null, is_truthy, lookup, lookup_array, read_paths

def extract_path(payloads: DataFrame, results_path: str, element: str, payload: str = "payload") -> DataFrame:
    """Rows of the array (or the one object) found at a dotted path; a missing path yields no rows."""
    others = [c for c in payloads.columns if c != payload]
    items = lookup_array(F.col(payload), results_path, element, single=True)
    return payloads.select(*others, F.explode(items).alias("item"))


def normalise_pages(
    pages: DataFrame,
    element: str,
    results_path: str = "",
    has_more_path: str | None = None,
    next_link_path: str | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """Items of all pages a source would have been asked for: (source, page, position, item).

    Reading stops behind the first page that names no further one, and before the first page
    whose results are no list; a JSON null is none. A missing path counts as an empty list.
    ``max_pages`` is a limit that a caller may set; without it all landed pages count. The stop
    of each source is one row of an aggregate, so a source with most of the pages is read by all
    tasks, and only pages that are kept have their items parsed.
    """
    read = pages if max_pages is None else pages.where(F.col("page") <= max_pages)
    payload = F.col("payload")
    more_path = next_link_path or has_more_path
    wanted = {path: "string" for path in (results_path, more_path) if path}
    found = read_paths(payload, wanted) if wanted else {}
    results = found.get(results_path, payload)
    is_list = F.startswith(F.trim(results), F.lit("[")) | (results.isNull() & ~is_json_null(payload, results_path))
    is_list = F.coalesce(is_list, F.lit(False))
    last = ~is_truthy(found[more_path]) if more_path else F.lit(False)
    stops = (
        read.select("source", "page", is_list.alias("is_list"), last.alias("last"))
        .groupBy("source")
        .agg(
            F.min(F.when(F.col("is_list") & F.col("last"), F.col("page"))).alias("last_page"),
            F.min(F.when(~F.col("is_list"), F.col("page"))).alias("bad_page"),
        )
    )
    items = (
        read_paths(payload, {results_path: f"array<{element}>"})[results_path]
        if results_path
        else F.from_json(payload, f"array<{element}>")
    )
    return (
        read.join(stops, "source")
        .where(F.coalesce(F.col("page") <= F.col("last_page"), F.lit(True)))
        .where(F.coalesce(F.col("page") < F.col("bad_page"), F.lit(True)))
        .select("source", "page", F.posexplode(items).alias("position", "item"))
    )


def json_array_rows(payloads: DataFrame, element: str, payload: str = "payload") -> DataFrame:
    """Rows of payloads that are JSON arrays themselves."""
    return extract_path(payloads, "", element, payload)


def json_files_rows(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """Rows of landed JSON arrays, one per line (or, with ``multi_line``, one per file); inferred unless declared."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema else reader).json(path)


def infer_element(pages: DataFrame, results_path: str = "") -> str | None:
    """The element type of the results of landed pages, from the results of all of them."""
    results = pages.select(lookup(F.col("payload"), results_path).alias("value")).where(F.trim("value").startswith("["))
    found = infer_json_schema(results)
    if found is None:
        return None
    element = T.DataType.fromDDL(found).elementType
    return None if isinstance(element, T.StringType) else element.simpleString()


def infer_json_schema(values: DataFrame, value: str = "value") -> str | None:
    """The DDL type that all JSON values of a column fit, from one aggregate over all of them.

    Fields that some values lack are part of it. Where values differ in kind the type is text; numbers
    with fractions are doubles. None if no value is JSON, or if objects and others are mixed.
    """
    found = values.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(value).cast("string"))).alias("s")).first()["s"]
    if found is None or found in ("VOID", "VARIANT"):
        return None
    for pattern, kind in ((r"OBJECT<>", "STRING"), (r"OBJECT<", "STRUCT<"), (r"DECIMAL\(\d+, *\d+\)", "DOUBLE"), (r"(?<=: )(VOID|VARIANT)|(?<=ARRAY<)(VOID|VARIANT)", "STRING")):
        found = re.sub(pattern, kind, found)
    return found


def csv_payload_rows(spark: SparkSession, path: str, schema: str | None = None, **options: str) -> DataFrame:
    """Rows of landed CSV payloads, each file with its own header; types are inferred unless declared.

    Values with line breaks inside quotes need the option ``multiLine``.
    """
    reader = spark.read.option("header", "true").options(**options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(path)


def csv_text_rows(payloads: DataFrame, schema: str, payload: str = "payload") -> DataFrame:
    """Rows of CSV payloads held in a column; the first line is the header.

    Every line is a record: payloads with line breaks inside quotes are to be landed as files.
    """
    others = [c for c in payloads.columns if c != payload]
    lines = F.filter(F.split(F.col(payload), "\r?\n"), lambda line: line != "")
    body = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    return (
        payloads.select(*others, F.posexplode(body).alias("line", "text"))
        .select(*others, "line", F.from_csv("text", schema).alias("r"))
        .select(*others, "line", "r.*")
    )


def xml_payload_rows(spark: SparkSession, path: str, row_tag: str = "row", schema: str | None = None) -> DataFrame:
    """Rows of landed XML payloads by row element."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def xml_text_rows(payloads: DataFrame, element: str, row_tag: str = "row", payload: str = "payload") -> DataFrame:
    """Rows of XML payloads held in a column, by row element below the root."""
    others = [c for c in payloads.columns if c != payload]
    read = F.from_xml(F.col(payload), f"`{row_tag}` array<{element}>")
    return payloads.select(*others, F.explode(read[row_tag]).alias("item")).select(*others, "item.*")


def parse_value(df: DataFrame, schema: str | T.StructType, value: str = "value") -> DataFrame:
    """JSON values as columns of a declared schema; a value that is no JSON object goes to ``_corrupt``."""
    declared = schema if isinstance(schema, T.StructType) else T.DataType.fromDDL(schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    others = [c for c in df.columns if c != value]
    wanted = T.StructType([*declared, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(value).cast("string"), wanted, options)
    return df.select(*others, F.col(value).alias("_raw"), parsed.alias("v")).select(*others, "_raw", "v.*")


def value_type(declared: Mapping | str | None) -> T.StructType | None:
    """The type of message values as declared: Spark's JSON form of a struct, or columns as DDL."""
    try:
        found = T.StructType.fromJson(dict(declared)) if isinstance(declared, Mapping) else T.DataType.fromDDL(declared or "")
    except (KeyError, TypeError, PySparkException):
        return None
    return found if isinstance(found, T.StructType) and len(found) else None


def decode_values(df: DataFrame, declared: Mapping | str | None, value: str = "value") -> DataFrame:
    """Message values as columns, beside ``_raw``, ``_corrupt`` and ``_message``, the other columns of ``df``.

    A value that is no JSON object has its text in ``_corrupt``, so that no message is lost (see
    ``split_decoded``). If what is declared is no type, the type is taken from all values; without any,
    or if nothing is declared, the value stays text.
    """
    wanted = value_type(declared)
    if wanted is None and declared is not None and not df.isStreaming:
        wanted = value_type(infer_json_schema(df, value))
    others = [c for c in df.columns if c != value]
    kept = df.select(*([F.struct(*others).alias("_message")] if others else []), F.col(value).cast("string").alias(value))
    if wanted is None:
        return kept.withColumns({"_raw": F.col(value), "_corrupt": F.lit(None).cast("string")})
    return parse_value(kept, wanted, value)


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, dead letters: the raw value with what came with it, such as key, offset and time)."""
    beside = ["_message.*"] if "_message" in decoded.columns else []
    rows = decoded.where(F.col("_corrupt").isNull()).drop("_raw", "_corrupt", "_message")
    return rows, decoded.where(F.col("_corrupt").isNotNull()).select(*beside, F.col("_raw").alias("raw_value"))


def value_state(raw: Column, corrupt: Column) -> Column:
    """``parsed``, ``dead_letter`` for values that are no JSON, ``empty`` for null."""
    return F.when(raw.isNull(), "empty").when(corrupt.isNotNull(), "dead_letter").otherwise("parsed")


def split_values(df: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, dead letters with their raw value). Null values count as parsed with null columns."""
    rows = parse_value(df, schema, value)
    good = rows.where(F.col("_corrupt").isNull()).drop("_corrupt", "_raw")
    bad = rows.where(F.col("_corrupt").isNotNull()).select(
        *[c for c in df.columns if c != value], F.col("_raw").alias(value)
    )
    return good, bad
