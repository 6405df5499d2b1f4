"""Records as documents: addressed by index and id, replaced, deleted and searched as tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_rows(df: DataFrame, index: Column, id_column: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """One document per record: index, id (null lets the store pick one) and the record as JSON."""
    return df.select(
        index.alias("_index"),
        (F.col(id_column).cast("string") if id_column else F.lit(None).cast("string")).alias("_id"),
        F.to_json(F.struct(*(fields or df.columns))).alias("_source"),
    )


def upsert_documents(writes: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """The documents after a series of writes: the last write of an id wins.

    ``result`` says whether that write created the document or replaced an earlier one. Tasks
    keep one row per id before the shuffle, so an id written over and over is no hot spot.
    """
    payload = [c for c in writes.columns if c != id_column]
    return (
        writes.groupBy(id_column)
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("newest"), F.count(F.lit(1)).alias("writes"))
        .select(
            id_column,
            "newest.*",
            F.when(F.col("writes") > 1, F.lit("updated")).otherwise(F.lit("created")).alias("result"),
        )
    )


def delete_documents(documents: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The documents that stay; ids may repeat."""
    return documents.join(ids.select(id_column).distinct(), id_column, "left_anti")


def delete_results(documents: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """For each id to delete, whether there was such a document."""
    present = documents.select(id_column).distinct().withColumn("present", F.lit(True))
    outcome = F.when(F.col("present"), F.lit("deleted")).otherwise(F.lit("not_found"))
    return ids.select(id_column).distinct().join(present, id_column, "left").select(id_column, outcome.alias("result"))


def search_documents(
    documents: DataFrame, predicate: Column, order: Sequence[Column], size: int = 10, from_: int = 0
) -> DataFrame:
    """Matching documents in a total order, ``size`` of them after the first ``from_``."""
    return documents.where(predicate).orderBy(*order).offset(from_).limit(size)


def stamp_metrics(metrics: DataFrame, moment: datetime | Column | None = None) -> DataFrame:
    """Give a metrics row its ``@timestamp`` unless it has one."""
    if "@timestamp" in metrics.columns:
        return metrics
    if moment is None:
        stamp = F.current_timestamp()
    else:
        stamp = moment if isinstance(moment, Column) else F.lit(moment)
    return metrics.withColumn("@timestamp", stamp)
