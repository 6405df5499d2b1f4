"""Publication by manifest: rows are written once, and what is known of them only afterwards is one row per run.

A source's rows lie below ``data/source=S/attempt=A``, one attempt for each time they were written. The manifest says which
attempt a run stands by, with tier, scores and schema result; its newest row for a source and run holds. Readers join the
two, so an attempt that no run stands by is invisible: a failed write, a repeated run's older copy, a copy under an older
grade. ``retire`` deletes those files later.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from typing import Any
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from assayer.operators.latest import latest_per_key
from assayer.session import list_folders, remove_path

MANIFEST_SCHEMA = (
    "source_name string, run_id string, attempt string, data_classification string, record_count bigint, "
    "metric_completeness double, metric_accuracy double, metric_timeliness double, schema_valid boolean, "
    "schema_error_count int, schema_warning_count int, processing_timestamp timestamp_ntz, published_at timestamp"
)
COLUMNS = [c.split()[0] for c in MANIFEST_SCHEMA.split(", ")]
QUALITY = (
    "data_classification", "metric_completeness", "metric_accuracy", "metric_timeliness", "schema_valid",
    "schema_error_count", "schema_warning_count", "processing_timestamp", "source_name",
)


def source_folder(store: str, source: str) -> str:
    return f"{store.rstrip('/')}/data/source={quote(source, safe='')}"


def write_attempt(df: DataFrame, store: str, source: str, counts: Sequence[Column]) -> tuple[str, dict[str, Any]]:
    """Write rows to their final place: (the attempt, ``counts`` of them, observed on the way). Nobody sees them yet."""
    attempt, seen = f"a-{uuid.uuid4().hex}", Observation()
    df.observe(seen, *counts).write.parquet(f"{source_folder(store, source)}/attempt={attempt}")
    return attempt, seen.get


def commit(spark: SparkSession, store: str, source: str, run_id: str, attempt: str, row: Row, processed_at: datetime) -> None:
    """Let a run stand by an attempt, with the grade in ``row``; whatever it stood by before is out."""
    entry = (
        source, run_id, attempt, row["data_classification"], row["record_count"], row["completeness"], row["accuracy"], row["timeliness"],
        row["schema_valid"], row["schema_error_count"], row["schema_warning_count"],
    )
    columns = MANIFEST_SCHEMA.split(", ")[: len(entry)]  # all but the two moments
    moment = F.lit(processed_at.isoformat(sep=" ")).cast("timestamp_ntz")
    entries = spark.createDataFrame([entry], ", ".join(columns)).select(
        "*", moment.alias("processing_timestamp"), F.current_timestamp().alias("published_at")
    )
    append_entry(entries, store, source)


def append_entry(entries: DataFrame, store: str, source: str) -> None:
    """Write manifest rows to a folder of their own, so that no two writers meet."""
    folder = f"{manifest_folder(store, source)}/entry=e-{uuid.uuid4().hex}"
    entries.select(*COLUMNS).coalesce(1).write.parquet(folder)


def manifest_folder(store: str, source: str | None = None) -> str:
    root = f"{store.rstrip('/')}/manifest"
    return root if source is None else f"{root}/of={quote(source, safe='')}"


def manifest(spark: SparkSession, store: str, source: str | None = None) -> DataFrame:
    """What every run of every source, or of one, stands by: one row each, the newest; no rows before the first publication."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_folder(store, source)).select(*COLUMNS)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest_per_key(rows, ["source_name", "run_id"], ["published_at", "attempt"])


def regrade(spark: SparkSession, store: str, source: str, run_id: str, tier: str) -> None:
    """Give a published run another tier. Its rows stay where they are."""
    entries = manifest(spark, store, source).where(F.col("run_id") == run_id)
    if entries.isEmpty():
        raise ValueError(f"run {run_id!r} has not published {source!r}")
    append_entry(entries.withColumns({"data_classification": F.lit(tier), "published_at": F.current_timestamp()}), store, source)


def published(spark: SparkSession, store: str, source: str, tier: str | None = None, run_id: str | None = None) -> DataFrame:
    """A source's published rows with their quality columns and ``run_id``, of one tier or run or of all.

    The manifest has a row for each run, which Spark broadcasts by its size; it prunes the attempts that are read at all.
    """
    wanted = manifest(spark, store, source)
    if tier is not None:
        wanted = wanted.where(F.col("data_classification") == tier)
    if run_id is not None:
        wanted = wanted.where(F.col("run_id") == run_id)
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(source_folder(store, source))
    except AnalysisException:
        raise ValueError(f"{source!r} has not been published") from None
    own = [c for c in rows.columns if c not in (*QUALITY, "run_id", "attempt")]
    joined = rows.select(*own, F.col("attempt").cast("string").alias("attempt")).join(wanted.drop("record_count", "published_at"), "attempt")
    return joined.select(*own, *QUALITY, "run_id")


def retire(spark: SparkSession, store: str, source: str) -> int:
    """Delete the attempts of a source that no run stands by, and say how many. Not to be run beside a write of this source."""
    entries = manifest(spark, store, source).select("attempt")
    held = {f"attempt={r['attempt']}" for r in entries.toLocalIterator()}
    folder = source_folder(store, source)
    old = [name for name in list_folders(spark, folder) if name.startswith("attempt=") and name not in held]
    for name in old:
        remove_path(spark, f"{folder}/{name}")
    return len(old)
