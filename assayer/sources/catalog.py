"""Catalog tables and the catalog of sources."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.sources.config import SECRET, all_sources, without_secrets


def read_table(spark: SparkSession, table: str | None, database: str | None = None) -> DataFrame:
    """A table of the catalog."""
    if not table:
        raise ValueError("a table source needs a table name")
    return spark.read.table(f"{database}.{table}" if database else table)


def describe_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """One row per column of every table in a database."""
    rows = [
        (t.name, c.name, c.dataType, c.isPartition)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
        for c in spark.catalog.listColumns(f"{database}.{t.name}" if database else t.name)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string, is_partition boolean")


def catalog_rows(configured: DataFrame) -> DataFrame:
    """One row per configured source (name, family, settings as a map, enabled, streaming): where its data lies, and no secrets."""
    settings = F.map_filter("settings", lambda k, _: ~F.lower(k).rlike(SECRET.pattern))

    def first_of(*keys: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at("settings", F.lit(k)), F.lit("")) for k in keys], F.lit(""))

    location = F.when(F.col("family") == "database", first_of("table", "query")).when(F.col("family") == "kafka", first_of("topic")).otherwise(first_of("path", "url"))
    return configured.select("name", "family", location.alias("location"), "enabled", "streaming", F.to_json(settings).alias("settings"))


def source_catalog(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """One row per source of a configuration; secrets are left out at every depth."""
    rows = [
        (
            s.get("name"),
            family,
            {k: v if isinstance(v, str) else json.dumps(v, sort_keys=True) for k, v in sorted(without_secrets(s).items())},
            bool(s.get("enabled", True)),
            bool(s.get("streaming_enabled", False)),
        )
        for family, s in all_sources(config)
    ]
    return catalog_rows(spark.createDataFrame(rows, "name string, family string, settings map<string,string>, enabled boolean, streaming boolean"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of several sources; columns a source lacks are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
