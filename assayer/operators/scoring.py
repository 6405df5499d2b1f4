"""Completeness, accuracy and timeliness of a dataset from one aggregate scan.

The scan yields *counts*, and counts add up: over groups, over micro-batches, over days.
Scores are ratios of counts and are always derived last, so a score over many batches is
the score of the whole, not an average of averages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions import cells

# The least scores of each tier and the age at which data counts as stale.
TIER_THRESHOLDS: dict[str, dict[str, float]] = {
    "bronze": {"completeness": 0.7, "accuracy": 0.6, "timeliness": 0.5},
    "silver": {"completeness": 0.8, "accuracy": 0.8, "timeliness": 0.7},
    "gold": {"completeness": 0.95, "accuracy": 0.9, "timeliness": 0.85},
}
MAX_AGE_DAYS = 30
NEUTRAL_TIMELINESS = 0.5
STREAM_TIMELINESS = 1.0

COUNT_COLUMNS = ("record_count", "cell_count", "missing_cells", "violations", "age_days", "dated_count")
SCORE_COLUMNS = ("completeness", "accuracy", "timeliness")


@dataclass(frozen=True)
class QualitySpec:
    """How one dataset is scored and graded.

    ``rules`` maps a column to any of ``min`` with ``max``, ``pattern`` and ``allowed_values``.
    ``streaming`` may be a condition on the group columns where several sources share a frame.
    ``metrics`` holds further named aggregate columns that ride in the same scan; they are
    not additive counts and so are left out when partial counts are merged.
    """

    name: str = "unnamed_source"
    rules: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    date_column: str | None = None
    max_age_days: float = MAX_AGE_DAYS
    streaming: bool | Column = False
    thresholds: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: TIER_THRESHOLDS)
    metrics: Mapping[str, Column] = field(default_factory=dict)


def rule_violations(df: DataFrame, rules: Mapping[str, Mapping[str, Any]]) -> list[tuple[str, str, Column]]:
    """(column, kind, condition) of every rule on a column that is there; others are skipped."""
    found: list[tuple[str, str, Column]] = []
    for column, rule in rules.items():
        if column not in df.columns:
            continue
        kind = df.schema[column].dataType
        if "min" in rule and "max" in rule:
            value = cells.comparable(column, kind, rule["min"], rule["max"])
            found.append((column, "range", cells.outside(value, rule["min"], rule["max"])))
        if "pattern" in rule:
            found.append((column, "pattern", cells.lacks(cells.cell(column), rule["pattern"])))
        if "allowed_values" in rule:
            value = cells.comparable(column, kind, *rule["allowed_values"])
            found.append((column, "allowed_values", cells.not_one_of(value, rule["allowed_values"])))
    return found


def as_of_column(as_of: date | datetime | str | Column | None) -> Column:
    """The day that ages are measured against; today where none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)[:10]).cast("date")


def count_aggregates(df: DataFrame, spec: QualitySpec, as_of=None) -> list[Column]:
    """The aggregate columns behind all three scores; each is one running number per group."""
    fields = df.schema.fields
    missing = cells.total(
        [cells.as_flag(cells.is_missing(f.name, f.dataType)) for f in fields if f.nullable or isinstance(f.dataType, cells.FLOATING)]
    )
    violations = cells.total([cells.as_flag(bad) for _, _, bad in rule_violations(df, spec.rules)])
    if spec.date_column in df.columns:
        age = cells.age_in_days(spec.date_column, df.schema[spec.date_column].dataType, as_of_column(as_of))
    else:
        age = F.lit(None).cast("int")
    return [
        F.count(F.lit(1)).alias("record_count"),
        (F.count(F.lit(1)) * F.lit(len(fields))).alias("cell_count"),
        F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("missing_cells"),
        F.coalesce(F.sum(violations), F.lit(0)).cast("bigint").alias("violations"),
        F.sum(age).cast("bigint").alias("age_days"),
        F.count(age).alias("dated_count"),
    ]


def count_cells(df: DataFrame, spec: QualitySpec, as_of=None, by: Sequence[str] = ()) -> DataFrame:
    """Counts per group, or one row for the whole dataset. Group columns count as cells too.

    A group with a third of all rows is no hot spot: every task reduces its share of the group
    to one row before anything is shuffled.
    """
    extra = [metric.alias(name) for name, metric in spec.metrics.items()]
    return df.groupBy(*by).agg(*count_aggregates(df, spec, as_of), *extra)


def merge_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the union of several parts from the counts of the parts."""
    return counts.groupBy(*by).agg(
        *[
            (F.sum(name) if name == "age_days" else F.coalesce(F.sum(name), F.lit(0))).cast("bigint").alias(name)
            for name in COUNT_COLUMNS
        ]
    )


def score_columns(spec: QualitySpec, has_date: bool) -> dict[str, Column]:
    """The three scores over a row of counts."""
    filled = (F.col("record_count") > 0) & (F.col("cell_count") > 0)

    def share_without(part: str) -> Column:
        return F.when(filled, F.lit(1.0) - F.col(part) / F.col("cell_count").cast("double")).otherwise(F.lit(0.0))

    if has_date:
        average_age = F.col("age_days") / F.when(F.col("dated_count") > 0, F.col("dated_count").cast("double"))
        fresh = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - average_age / F.lit(float(spec.max_age_days))))
        timeliness = F.when(F.col("dated_count") > 0, fresh).otherwise(F.lit(NEUTRAL_TIMELINESS))
    else:
        streaming = spec.streaming if isinstance(spec.streaming, Column) else F.lit(spec.streaming)
        timeliness = F.when(streaming, F.lit(STREAM_TIMELINESS)).otherwise(F.lit(NEUTRAL_TIMELINESS))
    return {
        "completeness": share_without("missing_cells"),
        "accuracy": share_without("violations" if spec.rules else "missing_cells"),
        "timeliness": timeliness,
    }


def scores_from_counts(counts: DataFrame, spec: QualitySpec, has_date: bool) -> DataFrame:
    """Add the three scores to rows of counts."""
    return counts.withColumns(score_columns(spec, has_date))


def score(df: DataFrame, spec: QualitySpec, as_of=None, by: Sequence[str] = ()) -> DataFrame:
    """Counts and scores of a dataset, or of each group of it, in one scan."""
    return scores_from_counts(count_cells(df, spec, as_of, by), spec, spec.date_column in df.columns)


def rule_breaches(df: DataFrame, rules: Mapping[str, Mapping[str, Any]], keys: Sequence[str]) -> DataFrame:
    """One row per broken rule and record: the keys, the column and the kind of rule."""
    found = rule_violations(df, rules)
    if not found:
        return df.select(*keys, F.lit("").alias("column_name"), F.lit("").alias("issue_type")).where(F.lit(False))
    issues = F.array(
        *[
            F.when(bad, F.struct(F.lit(column).alias("column_name"), F.lit(kind).alias("issue_type")))
            for column, kind, bad in found
        ]
    )
    return (
        df.select(*keys, F.explode(F.filter(issues, lambda issue: issue.isNotNull())).alias("issue"))
        .select(*keys, "issue.column_name", "issue.issue_type")
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells of each column and the record count, in one row."""
    wanted = columns or df.columns
    return df.agg(
        *[
            F.count_if(cells.is_missing(name, df.schema[name].dataType)).alias(f"{name}_missing")
            for name in wanted
        ],
        F.count(F.lit(1)).alias("record_count"),
    )


def metrics_long(scores: DataFrame, metrics: Sequence[str] = SCORE_COLUMNS, keys: Sequence[str] = ()) -> DataFrame:
    """One row per metric with four decimals."""
    rounded = scores.select(*keys, *[F.round(F.col(m), 4).alias(m) for m in metrics])
    return rounded.unpivot(list(keys), list(metrics), "metric", "score")
