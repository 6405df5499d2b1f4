"""Run, source and event reports over the monitoring tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.text import score_text
from assayer.operators.latest import latest_per_key, newest_rows
from assayer.operators.tiering import TIERS

# Fixed value: the event log keeps this many events.
EVENT_LOG_SIZE = 100
RECENT_SOURCES = 10
FIRST_SOURCES = 5


def run_totals(source_runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of a run: sources done and failed, records, records per tier, start, end and duration.

    A failed source adds to ``sources_failed`` only, and stream sources add no records.
    """
    done = F.col("status") == "success"
    counted = done & (F.col("source_type") != "kafka")

    def records(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("record_count"))), F.lit(0)).cast("bigint").alias(name)

    return (
        source_runs.groupBy(*by)
        .agg(
            F.count_if(done).alias("sources_processed"),
            F.count_if(F.col("status") == "failed").alias("sources_failed"),
            records(counted, "records_processed"),
            *[records(counted & (F.col("classification") == tier), f"{tier}_count") for tier in TIERS],
            F.min("finished_at").alias("start_time"),
            F.max("finished_at").alias("end_time"),
        )
        .withColumn(
            "duration_seconds",
            (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp")))
            / F.lit(1e6),
        )
    )


def tier_distribution(source_runs: DataFrame) -> DataFrame:
    """Records per tier; all four tiers are always there."""
    sums = source_runs.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("classification") == tier, F.col("record_count"))), F.lit(0))
            .cast("bigint")
            .alias(tier)
            for tier in TIERS
        ]
    )
    return sums.unpivot([], list(TIERS), "tier", "records")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def sources_by_type(source_runs: DataFrame) -> DataFrame:
    """Sources per type; a source with many runs counts once."""
    return counts_by(source_runs.select("source_name", "source_type").distinct(), "source_type")


def validation_stats(validations: DataFrame, is_valid: Column) -> DataFrame:
    """Valid, invalid and total results, and the whole percentage of valid ones (rounded down)."""
    return validations.agg(F.count_if(is_valid).alias("valid_count"), F.count(F.lit(1)).alias("total_count")).select(
        "valid_count",
        (F.col("total_count") - F.col("valid_count")).alias("invalid_count"),
        "total_count",
        F.when(F.col("total_count") > 0, F.floor(F.col("valid_count") * 100.0 / F.col("total_count")))
        .otherwise(F.lit(0))
        .cast("int")
        .alias("valid_percentage"),
    )


def records_per_day(source_runs: DataFrame, last_day: date, days: int = 7) -> DataFrame:
    """Records per day over the last days; days without a run show 0."""
    end = F.lit(last_day)
    day = F.col("finished_at").cast("date")
    summed = (
        source_runs.where(day.between(F.date_sub(end, days - 1), end))
        .groupBy(day.alias("day"))
        .agg(F.sum("record_count").cast("bigint").alias("records"))
    )
    spine = source_runs.sparkSession.range(days).select(F.date_sub(end, F.col("id").cast("int")).alias("day"))
    return spine.join(summed, "day", "left").select("day", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"))


def latest_status(source_runs: DataFrame) -> DataFrame:
    """The last result of every source."""
    return latest_per_key(source_runs, ["source_name"], ["finished_at", "seq"])


def recent_activity(source_runs: DataFrame, limit: int = RECENT_SOURCES) -> DataFrame:
    """The newest results that belong to a run."""
    return newest_rows(source_runs, ["finished_at", "seq"], limit, F.col("finished_at").isNotNull())


def first_sources(sources: DataFrame, limit: int = FIRST_SOURCES, position: str = "seq") -> DataFrame:
    """The first sources in the order they are configured in, as told by ``position``."""
    return sources.groupBy("source_name").agg(F.min(position).alias("at")).orderBy("at").limit(limit).select("source_name")


def schema_detail(in_use: DataFrame, latest: DataFrame, fields: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Each schema in use with its newest version, its number of fields and its last change, as far as known."""
    counted = fields.groupBy("schema_name").agg(F.count(F.lit(1)).alias("field_count"))
    details = [latest, counted]
    if events is not None:
        details.append(events.groupBy("schema_name").agg(F.max("timestamp").alias("changed_at")))
    return source_detail(in_use, *details, key="schema_name")


def recent_events(events: DataFrame, event_type: str | None = None, limit: int = EVENT_LOG_SIZE) -> DataFrame:
    """The newest events, optionally of one type; an event without a time counts as new."""
    stamped = events.withColumn("ts", F.coalesce("ts", F.current_timestamp().cast(events.schema["ts"].dataType)))
    wanted = None if event_type is None else F.col("event_type") == event_type
    return newest_rows(stamped, ["ts", "event_id"], limit, wanted)


def pending_sources(configured: DataFrame, statuses: DataFrame, key: str) -> DataFrame:
    """Configured sources without any result. Results are reduced to distinct keys before the join."""
    return configured.join(statuses.select(key).distinct(), key, "left_anti").withColumn("status", F.lit("pending"))


def with_pending(configured: DataFrame, latest: DataFrame) -> DataFrame:
    """Latest results plus a pending row for each configured source that never ran."""
    waiting = pending_sources(configured.select("source_name", "source_type"), latest, "source_name")
    return latest.unionByName(waiting, allowMissingColumns=True)


def source_detail(configured: DataFrame, *details: DataFrame, key: str) -> DataFrame:
    """Configuration of each source with whatever further one-row-per-source frames know of it."""
    joined = configured
    for detail in details:
        joined = joined.join(detail, key, "left")
    return joined


def score_table(scores: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Scores as text with four decimals, or N/A."""
    return scores.select(*keys, *[score_text(F.col(m)).alias(m) for m in metrics])



def merge_updates(updates: DataFrame, order: Sequence[str], history: str) -> DataFrame:
    """Counters after a series of partial updates: the last value given of each, and the history length.

    A null in an update leaves the counter as it was. An update counts towards the history
    when it names the time of its run (column ``history``).
    """
    moment = F.struct(*order)
    columns = [c for c in updates.columns if c not in order]
    return updates.agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), moment)).alias(c) for c in columns],
        F.count(history).alias("history_rows"),
    )
