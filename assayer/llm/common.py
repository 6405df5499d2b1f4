"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(column: str = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def id_bucket(buckets: int, column: str = "doc_id") -> Column:
    """crc32 of an id written as text, modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets


def held_out(buckets: int, rest: int, column: str = "doc_id") -> Column:
    """Whether a row is kept from learning; rows without an id always are."""
    return F.coalesce(id_bucket(buckets, column) == rest, F.lit(True))


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_batch(make: Callable[..., dict[str, list]], schema: pa.Schema, rows: int = 2000) -> Callable:
    """A ``mapInArrow`` function that calls ``make`` with the column lists of at most ``rows`` rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = make(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return run


def sampled(df: DataFrame, key: str, rows: int, counted: int) -> DataFrame:
    """A sample of about ``rows`` of ``counted`` rows, by a hash of ``key``, so that every run takes the same."""
    if counted <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < int(1_000_000 * rows / counted))


def kept(name: str, make: Callable):
    """What a Python worker keeps between its tasks under a name; made where it is missing."""
    import sys
    from types import ModuleType

    home = sys.modules.setdefault("assayer_kept", ModuleType("assayer_kept")).__dict__
    if name not in home:
        home[name] = make()
    return home[name]
