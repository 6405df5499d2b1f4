"""The tier rule, and the columns that carry tier and scores into the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from assayer.operators.scoring import QualitySpec, score

TIERS = ("gold", "silver", "bronze", "rejected")


def merge_thresholds(
    defaults: Mapping[str, Mapping[str, float]], override: Mapping[str, Mapping[str, float]] | None
) -> dict[str, dict[str, float]]:
    """Thresholds of a source: its own ones laid over the defaults, metric by metric."""
    merged = {tier: dict(values or {}) for tier, values in defaults.items()}
    for tier, values in (override or {}).items():
        merged.setdefault(tier, {}).update(values or {})
    return merged


def tier_column(
    thresholds: Mapping[str, Mapping[str, float]],
    metrics: Mapping[str, Column],
    schema_valid: Column | None = None,
) -> Column:
    """First of gold, silver, bronze whose thresholds all hold, else rejected.

    A metric that was not measured counts as 0, an empty threshold set holds, and data that
    breaks its schema reaches bronze at most.
    """

    def holds(tier: str) -> Column:
        condition = F.lit(True)
        for metric, least in thresholds.get(tier, {}).items():
            condition = condition & (F.coalesce(metrics.get(metric, F.lit(0.0)), F.lit(0.0)) >= F.lit(float(least)))
        return condition

    return _first_tier(holds, schema_valid)


def _first_tier(holds: Callable[[str], Column], schema_valid: Column | None) -> Column:
    conforming = F.lit(True) if schema_valid is None else F.coalesce(schema_valid, F.lit(False))
    return (
        F.when(conforming & holds("gold"), F.lit("gold"))
        .when(conforming & holds("silver"), F.lit("silver"))
        .when(holds("bronze"), F.lit("bronze"))
        .otherwise(F.lit("rejected"))
    )


def numeric_metrics(scores: DataFrame) -> dict[str, Column]:
    """The columns of a score row that thresholds can be compared with."""
    return {f.name: F.col(f.name) for f in scores.schema.fields if isinstance(f.dataType, NumericType)}


def classify(
    scores: DataFrame,
    thresholds: Mapping[str, Mapping[str, float]],
    schema_valid: Column | None = None,
) -> DataFrame:
    """Add ``data_classification`` to rows of scores."""
    return scores.withColumn("data_classification", tier_column(thresholds, numeric_metrics(scores), schema_valid))


def threshold_maps(thresholds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Threshold rows ``(group, tier, metric, least)`` as one map of maps per group; the strictest of repeated ones."""
    strictest = thresholds.groupBy(*by, "tier", "metric").agg(F.max(F.col("least").cast("double")).alias("least"))
    per_tier = strictest.groupBy(*by, "tier").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "least"))).alias("metrics")
    )
    return per_tier.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("tier", "metrics"))).alias("thresholds"))


def classify_by_table(
    scores: DataFrame, thresholds: DataFrame, by: Sequence[str], schema_valid: Column | None = None
) -> DataFrame:
    """Grade groups by thresholds of their own, kept as rows ``(group, tier, metric, least)``.

    The rule is that of ``tier_column``; a group without any row for a tier has no thresholds there.
    A group has a handful of thresholds, one per tier and metric, which become one row each.
    """
    measured = F.create_map(*[c for name, value in numeric_metrics(scores).items() for c in (F.lit(name), value.cast("double"))])
    graded = scores.join(threshold_maps(thresholds, by), list(by), "left")

    def holds(name: str) -> Column:
        least = F.map_entries(F.try_element_at("thresholds", F.lit(name)))
        reached = F.forall(least, lambda t: F.coalesce(F.try_element_at(measured, t["key"]), F.lit(0.0)) >= t["value"])
        return F.coalesce(reached, F.lit(True))

    return graded.withColumn("data_classification", _first_tier(holds, schema_valid)).drop("thresholds")


def tier(df: DataFrame, spec: QualitySpec, as_of=None, by: Sequence[str] = (), schema_valid: Column | None = None) -> DataFrame:
    """Score and grade a dataset, or every group of it, in one scan."""
    return classify(score(df, spec, as_of, by), spec.thresholds, schema_valid)


def add_quality_columns(
    df: DataFrame,
    assessment: Row | Mapping,
    source_name: str,
    processed_at: datetime | Column | None = None,
    metrics: Sequence[str] = ("completeness", "accuracy", "timeliness"),
) -> DataFrame:
    """Tier, scores and schema result of the dataset as constant columns of each record.

    ``assessment`` is the one row that scoring a whole dataset yields, so nothing is joined.
    """
    row = assessment.asDict() if isinstance(assessment, Row) else dict(assessment)
    added = {"data_classification": F.lit(row["data_classification"])}
    added.update({f"metric_{name}": F.lit(row[name]) for name in metrics if row.get(name) is not None})
    if "schema_valid" in row:
        added["schema_valid"] = F.lit(bool(row["schema_valid"]))
        added["schema_error_count"] = F.lit(int(row["schema_error_count"]))
        added["schema_warning_count"] = F.lit(int(row["schema_warning_count"]))
    added["processing_timestamp"] = moment_column(processed_at)
    added["source_name"] = F.lit(source_name)
    return df.withColumns(added)


def add_group_quality_columns(df: DataFrame, graded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Tier and scores of each record's group, for datasets that arrive together in one frame.

    There is one grade for each group. Spark broadcasts them if their size in bytes, known from the
    finished aggregate, allows it, and splits large groups if not; nothing is computed beforehand.
    """
    grades = graded.select(
        *[F.col(name).alias(f"__{name}") for name in by],
        "data_classification",
        *[F.col(name).alias(f"metric_{name}") for name in ("completeness", "accuracy", "timeliness")],
    )
    same_group = reduce(and_, [df[name].eqNullSafe(grades[f"__{name}"]) for name in by])
    return df.join(grades, same_group, "left").drop(*[f"__{name}" for name in by])


def add_ingest_columns(df: DataFrame, tier_name: str | Column, ingested_at: datetime | Column | None = None) -> DataFrame:
    """When the data was taken in, and the tier it was saved under."""
    level = F.lit(tier_name) if isinstance(tier_name, str) else tier_name
    return df.withColumns({"ingestion_timestamp": moment_column(ingested_at), "classification_level": level})


def add_date_parts(df: DataFrame, moment: Column | str, parts: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Integer year, month and day, as far as configured; a text that is no date leaves the frame unchanged."""
    if isinstance(moment, str):
        try:
            value = F.lit(datetime.strptime(moment, "%Y-%m-%d").date())
        except ValueError:
            return df
    else:
        value = moment
    known = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({part: known[part](value) for part in parts if part in known})


def stamp_events(df: DataFrame, source_name: str, moment: Column | None = None) -> DataFrame:
    """Source name and time of day of handling, as each event carries them."""
    when = F.current_timestamp() if moment is None else moment
    return df.withColumns(
        {"source_name": F.lit(source_name), "timestamp": F.date_format(when, "yyyy-MM-dd HH:mm:ss")}
    )


def moment_column(value: datetime | Column | None) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz" if value.tzinfo is None else "timestamp")
