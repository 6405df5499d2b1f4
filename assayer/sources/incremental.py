"""Loads that take up only what changed since the last one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.latest import latest_per_key

STATE_SCHEMA = "source string, high_water timestamp_ntz, records bigint, saved_at timestamp"


def incremental_scan(
    df: DataFrame, modified: str, high_water: datetime | None, loaded: DataFrame | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows modified at the high-water mark or after it, or at no known time; everything on the first run.

    The filter reaches the scan. Rows of the very moment of the mark, and rows without a time, may have
    been written before: with ``loaded``, what was written so far, they are left out again, by ``keys`` and
    time, or by all columns if there are no keys.
    """
    if high_water is None:
        return df
    due = F.col(modified).isNull() | (F.col(modified) >= moment_literal(df, modified, high_water))
    rows = df.where(due)
    if loaded is None:
        return rows
    same = list(dict.fromkeys([*(keys or [c for c in df.columns if c in loaded.columns]), modified]))
    known = loaded.where(F.col(modified).isNull() | (F.col(modified) >= moment_literal(df, modified, high_water))).select(*(F.col(c).alias(f"__{c}") for c in same)).distinct()
    return rows.join(known, reduce(and_, [rows[c].eqNullSafe(known[f"__{c}"]) for c in same]), "left_anti")


def date_range(df: DataFrame, column: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows of a closed time interval; either end may be open."""
    kept = df
    if start is not None:
        kept = kept.where(F.col(column) >= moment_literal(df, column, start))
    if end is not None:
        kept = kept.where(F.col(column) <= moment_literal(df, column, end))
    return kept


def retain_days(df: DataFrame, column: str, days: int, as_of: datetime) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.where(F.col(column) >= moment_literal(df, column, as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))


def moment_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """A moment as a value of a column's type."""
    return F.lit(moment.isoformat(sep=" ")).cast(df.schema[column].dataType)


def load_high_water(spark: SparkSession, state_path: str, source: str) -> datetime | None:
    """The mark of a source's last load that was written completely, or None."""
    try:
        states = spark.read.schema(STATE_SCHEMA).parquet(state_path)
    except AnalysisException:
        return None
    found = latest_per_key(states.where(F.col("source") == source), ["source"], ["saved_at"]).collect()
    return found[0]["high_water"] if found else None


def advance_high_water(written: DataFrame, modified: str, state_path: str, source: str) -> None:
    """Move the mark to the newest row written; call it after the write committed.

    ``written`` must be the rows as they were written, not a source that may have changed since. Without
    new rows the mark stays.
    """
    (
        written.agg(
            F.max(F.col(modified).cast("timestamp_ntz")).alias("high_water"), F.count(F.lit(1)).alias("records")
        )
        .where(F.col("high_water").isNotNull())
        .select(F.lit(source).alias("source"), "high_water", "records", F.current_timestamp().alias("saved_at"))
        .write.mode("append")
        .parquet(state_path)
    )
