"""Bands, names and texts of the monitoring reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _band(score: Column, cuts: list[tuple[float, str]], rest: str) -> Column:
    expr = F.when(score.isNull(), F.lit("N/A"))
    for cut, label in cuts:
        expr = expr.when(score >= cut, F.lit(label))
    return expr.otherwise(F.lit(rest))


# The cut points of the report bands.
QUALITY_CUTS = [(0.9, "good"), (0.8, "medium"), (0.7, "borderline")]
GAUGE_CUTS = [(0.9, "good"), (0.7, "medium")]


def quality_band(score: Column) -> Column:
    """Four bands of a score: good, medium, borderline, poor."""
    return _band(score, QUALITY_CUTS, "poor")


def gauge_band(score: Column) -> Column:
    """Three bands of a gauge: good, medium, poor."""
    return _band(score, GAUGE_CUTS, "poor")


def match_band(match_ratio: Column) -> Column:
    """Three bands of a pattern match rate, with the cuts of the gauge."""
    return _band(match_ratio, GAUGE_CUTS, "poor")


def score_text(score: Column) -> Column:
    """A score with four decimals, or N/A."""
    return F.when(score.isNotNull(), F.format_string("%.4f", F.round(score, 4))).otherwise(F.lit("N/A"))


# The texts of ages and of monitoring events.
AGE_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
EVENT_RECEIVED = "Event received"
SOURCE_DONE = "Source successfully processed"
SOURCE_FAILED = "Source failed processing"
SCHEMA_UPDATED = "Schema '%s' updated"
SCHEMA_EVOLVED = "Schema '%s' evolved to version %s"
EVOLUTION_REQUESTED = "Evolution requested for schema '%s'"
RUN_DONE = "Processed %s records"
RUN_GOLD = " (%s gold)"
SOURCE_RECORDS = " %s records"


def elapsed_text(moment: Column, as_of: Column) -> Column:
    """Age of ``moment`` as text in the largest unit that fits; seconds have no singular form."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))
    seconds = F.floor(micros / F.lit(1_000_000))

    def phrase(unit: str) -> Column:
        n = F.floor(seconds / F.lit(AGE_UNITS[unit]))
        return F.concat(n.cast("string"), F.when(n == 1, F.lit(f" {unit} ago")).otherwise(F.lit(f" {unit}s ago")))

    return (
        F.when(moment.isNull(), F.lit(""))
        .when(seconds < AGE_UNITS["minute"], F.concat(seconds.cast("string"), F.lit(" seconds ago")))
        .when(seconds < AGE_UNITS["hour"], phrase("minute"))
        .when(seconds < AGE_UNITS["day"], phrase("hour"))
        .otherwise(phrase("day"))
    )


def count_text(n: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(n.cast("bigint"), 0)


def event_message(
    event_type: Column,
    *,
    message: Column | None = None,
    records_processed: Column | None = None,
    gold_count: Column | None = None,
    status: Column | None = None,
    record_count: Column | None = None,
    schema_event: Column | None = None,
    schema_name: Column | None = None,
    version: Column | None = None,
) -> Column:
    """One line of text per monitoring event; columns that do not apply to an event are null."""
    def given(column: Column | None, kind: str = "string") -> Column:
        return F.lit(None).cast(kind) if column is None else column

    message, status, schema_event = given(message), given(status), given(schema_event)
    schema_name, version = given(schema_name), given(version)
    records_processed, gold_count = given(records_processed, "bigint"), given(gold_count, "bigint")
    record_count = given(record_count, "bigint")

    plain = F.coalesce(message, F.lit(EVENT_RECEIVED))
    gold = F.when(gold_count > 0, F.format_string(RUN_GOLD, count_text(gold_count))).otherwise(F.lit(""))
    run = F.concat(F.format_string(RUN_DONE, count_text(records_processed)), gold)
    outcome = F.when(status == "success", F.lit(SOURCE_DONE)).otherwise(F.lit(SOURCE_FAILED))
    records = F.when(record_count != 0, F.format_string(SOURCE_RECORDS, count_text(record_count))).otherwise(F.lit(""))
    schema = (
        F.when(schema_event == "schema_updated", F.format_string(SCHEMA_UPDATED, schema_name))
        .when(schema_event == "schema_evolved", F.format_string(SCHEMA_EVOLVED, schema_name, version))
        .when(schema_event == "evolution_requested", F.format_string(EVOLUTION_REQUESTED, schema_name))
        .otherwise(plain)
    )
    return (
        F.when((event_type == "metrics") & records_processed.isNotNull(), run)
        .when((event_type == "source_status") & status.isNotNull(), F.concat(outcome, records))
        .when((event_type == "schema_event") & schema_event.isNotNull(), schema)
        .otherwise(plain)
    )


def table_name(prefix: str, tier: Column, source: Column) -> Column:
    """Name of a tier table: lower case, dashes as underscores."""
    return F.lower(F.translate(F.concat(F.lit(prefix), tier, F.lit("_"), source), "-", "_"))


def document_index(tier: Column, source: Column, day: Column) -> Column:
    """Daily index of a source's documents in one tier."""
    return F.lower(F.concat(tier, F.lit("_"), source, F.lit("_"), F.date_format(day, "yyyy-MM-dd")))


def daily_index(prefix: str, day: Column) -> Column:
    """Daily index of the run metrics."""
    return F.concat(F.lit(prefix + "-"), F.date_format(day, "yyyy.MM.dd"))
