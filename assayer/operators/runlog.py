"""Run logs as text lines: written as JSON after a marker, read back as tables."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.latest import latest_per_key

# The markers that precede a payload in a log line.
RUN_MARKER = "Pipeline metrics:"
SOURCE_MARKER = "Source metrics:"

LINE = r"^(\S+ \S+) .*?(" + RUN_MARKER + "|" + SOURCE_MARKER + r")\s*(\{.*\})\s*$"
RUN_SCHEMA = (
    "seq bigint, end_time double, sources_processed bigint, sources_failed bigint, records_processed bigint, "
    "bronze_count bigint, silver_count bigint, gold_count bigint, rejected_count bigint"
)
SOURCE_SCHEMA = (
    "seq bigint, source_name string, source_type string, status string, classification string, record_count bigint"
)
SOURCE_FIELDS = ("seq", "source_name", "source_type", "status", "classification", "record_count")
COUNTERS = ("sources_processed", "sources_failed", "records_processed", "bronze_count", "silver_count", "gold_count", "rejected_count")


def write_run_log(results: DataFrame, record: DataFrame, path: str, run_id: str) -> None:
    """Write a run's log lines: one for each source's result and one for its totals, after all of them by sequence.

    A run that is repeated replaces its own lines. ``read_run_log`` gives the lines of all runs.
    """
    when = F.current_timestamp()
    sources = results.select("seq", F.lit(SOURCE_MARKER).alias("marker"), F.to_json(F.struct("run_id", *SOURCE_FIELDS)).alias("payload"))
    end = F.unix_micros("end_time") / F.lit(1e6)
    totals = record.withColumn("seq", F.col("sources_processed") + F.col("sources_failed"))  # the sources are numbered from 0
    runs = totals.select("seq", F.lit(RUN_MARKER).alias("marker"), F.to_json(F.struct("run_id", "seq", end.alias("end_time"), *COUNTERS)).alias("payload"))
    stamp = F.date_format(when, "yyyy-MM-dd HH:mm:ss,SSS")
    lines = sources.unionByName(runs).select(F.concat_ws(" ", F.concat(stamp, F.lit(" - assayer - INFO -")), "marker", "payload").alias("value"))
    lines.write.mode("overwrite").text(f"{path}/run={quote(run_id, safe='')}")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The log lines of all runs, as ``parse_lines`` takes them."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def parse_lines(lines: DataFrame, tail: int | None = None) -> DataFrame:
    """Kind and payload of all log lines, or of the newest ``tail`` with a payload, by time and sequence.

    Lines without a marker or with a payload that is no JSON object (quotes may be single) are
    left out. Payloads are parsed, never evaluated.
    """
    parsed = lines.select(
        F.try_to_timestamp(F.regexp_extract("value", LINE, 1), F.lit("yyyy-MM-dd HH:mm:ss,SSS")).alias("logged_at"),
        F.when(F.regexp_extract("value", LINE, 2) == RUN_MARKER, "pipeline").otherwise("source").alias("kind"),
        F.regexp_extract("value", LINE, 3).alias("payload"),
    ).where(F.col("payload") != "")
    parsed = parsed.withColumn("seq", F.get_json_object("payload", "$.seq").cast("bigint")).where(F.col("seq").isNotNull())
    if tail is None:
        return parsed
    return parsed.orderBy(F.desc("logged_at"), F.desc("seq")).limit(tail)


def run_rows(parsed: DataFrame) -> DataFrame:
    """One row per logged run; counters it does not name are 0."""
    runs = parsed.where(F.col("kind") == "pipeline")
    read = runs.select("logged_at", F.from_json("payload", RUN_SCHEMA).alias("r")).select("logged_at", "r.*")
    return read.fillna(0, [c for c in read.columns if c not in ("logged_at", "seq", "end_time")])


def source_rows(parsed: DataFrame) -> DataFrame:
    """The last logged result per source."""
    found = parsed.where(F.col("kind") == "source")
    rows = found.select("logged_at", F.from_json("payload", SOURCE_SCHEMA).alias("r")).select("logged_at", "r.*")
    named = rows.where(F.col("source_name").isNotNull() & F.col("source_type").isNotNull())
    return latest_per_key(named, ["source_name"], ["logged_at", "seq"])
