"""Tier files and tier tables."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.tiering import TIERS, add_date_parts, add_ingest_columns
from assayer.session import list_folders, remove_path

log = logging.getLogger(__name__)


def tier_path(target_paths: Mapping[str, str], tier: str, source_name: str) -> str:
    """Folder of one source's data in one tier; a tier without a folder is an error."""
    if tier not in target_paths:
        raise ValueError(f"no target path for tier {tier!r}")
    return f"{target_paths[tier].rstrip('/')}/{source_name}"


def tier_table_name(tier: str, source_name: str, prefix: str = "data_") -> str:
    """Table of one source's data in one tier."""
    return re.sub("-", "_", f"{prefix}{tier}_{source_name}").lower()


def write_tier_files(
    df: DataFrame, tier: str, source_name: str, target_paths: Mapping[str, str], ingested_at: datetime, run_id: str | None = None
) -> str:
    """Write a graded dataset as parquet, one folder per ingestion day and run.

    A repeated run replaces what it wrote itself and nothing else. A run without an id goes by its moment.
    """
    path = tier_path(target_paths, tier, source_name)
    stamped = add_ingest_columns(df, tier, ingested_at)
    run = quote(run_id or f"at {ingested_at.isoformat()}", safe="")
    stamped.write.mode("overwrite").parquet(f"{path}/ingestion_date={ingested_at.date().isoformat()}/ingestion_run={run}")
    return path


def retire_older_files(spark: SparkSession, tier: str | None, source_name: str, target_paths: Mapping[str, str], run_day: date, run_id: str) -> int:
    """Delete what a run of this id left of a source under other tiers or on other days, and say how many copies that were.

    To be called once the new copy is there, for datasets that have one grade as a whole. Without a ``tier`` the new
    copy is not among the files, and all of them go.
    """
    run, gone = f"ingestion_run={quote(run_id, safe='')}", 0
    kept = f"{tier_path(target_paths, tier, source_name)}/ingestion_date={run_day.isoformat()}/{run}" if tier else None
    for folder in dict.fromkeys(tier_path(target_paths, name, source_name) for name in target_paths):
        for day in list_folders(spark, folder):
            if day.startswith("ingestion_date=") and f"{folder}/{day}/{run}" != kept:
                gone += remove_path(spark, f"{folder}/{day}/{run}")
    return gone


def write_tier_table(
    df: DataFrame,
    tier: str,
    source_name: str,
    run_day: date,
    *,
    database: str | None = None,
    prefix: str = "data_",
    path: str | None = None,
    mode: str = "append",
    parts: Sequence[str] = ("year", "month", "day"),
    table_format: str = "parquet",
    run_id: str | None = None,
) -> str:
    """Append a graded dataset to its tier table, partitioned by the run's day.

    With a ``run_id`` the table is also partitioned by ``ingestion_run``, and a repeated run replaces its own partition
    instead of adding to it.
    """
    name = tier_table_name(tier, source_name, prefix)
    if database:
        name = f"{database}.{name}"
    dated = add_date_parts(df, run_day.isoformat(), parts)
    if run_id is None:
        writer = dated.write.mode(mode).format(table_format).partitionBy(*parts)
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return name
    run = quote(run_id, safe="")
    tagged = dated.withColumn("ingestion_run", F.lit(run))
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        tagged.select(*spark.read.table(name).columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
    else:
        writer = tagged.write.format(table_format).partitionBy(*parts, "ingestion_run")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def retire_older_partitions(
    spark: SparkSession, tier: str | None, source_name: str, run_day: date, run_id: str, *,
    database: str | None = None, prefix: str = "data_", parts: Sequence[str] = ("year", "month", "day"), **_,
) -> int:
    """Drop the partitions that a run of this id left in the tables of other tiers or on other days; see ``retire_older_files``."""
    run, gone = quote(run_id, safe=""), 0
    today = [f"{part}={getattr(run_day, part)}" for part in parts]
    for level in TIERS:
        name = tier_table_name(level, source_name, prefix)
        name = f"{database}.{name}" if database else name
        if not spark.catalog.tableExists(name) or "ingestion_run" not in spark.read.table(name).columns:
            continue
        for row in spark.sql(f"SHOW PARTITIONS {name} PARTITION (ingestion_run='{run}')").collect():  # the days of one run
            days = [d for d in row["partition"].split("/") if not d.startswith("ingestion_run=")]
            if level != tier or days != today:
                where = ", ".join(f"{k}='{v}'" for k, v in (d.split("=", 1) for d in [*days, f"ingestion_run={run}"]))
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({where})")
                gone += 1
    return gone


def write_with_fallback(
    df: DataFrame, tier: str, source_name: str, target_paths: Mapping[str, str], ingested_at: datetime,
    run_id: str | None = None, **table
) -> tuple[str, str]:
    """Write to the tier table, or to tier files where that fails: ('table' or 'files', where it went)."""
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier!r}")
    try:
        stamped = add_ingest_columns(df, tier, ingested_at)
        return "table", write_tier_table(stamped, tier, source_name, ingested_at.date(), run_id=run_id, **table)
    except Exception as failure:  # the table store may be down in ways Spark reports differently
        log.warning("table write of %s failed, writing files: %s", source_name, failure)
        return "files", write_tier_files(df, tier, source_name, target_paths, ingested_at, run_id)


def write_rejected(
    df: DataFrame,
    issues: DataFrame,
    source_name: str,
    run_id: str,
    target_paths: Mapping[str, str],
    ingested_at: datetime,
) -> tuple[str, str]:
    """Write rejected data to its own place, and beside it the issues that explain the rejection.

    Every run and source has a folder of its own, so that sources can be written at once.
    """
    path = write_tier_files(df, "rejected", source_name, target_paths, ingested_at, run_id)
    issues_path = tier_path(target_paths, "rejected", "issues")
    own = f"{issues_path}/rejected_run={quote(run_id, safe='')}/rejected_source={quote(source_name, safe='')}"
    issues.withColumns({"run_id": F.lit(run_id), "source_name": F.lit(source_name)}).write.mode("overwrite").parquet(own)
    return path, issues_path
