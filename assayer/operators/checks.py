"""Schema validation: field checks from the frame's type alone, value checks from one aggregate scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import cells
from assayer.operators.schema import SchemaDefinition, declared_type, is_compatible

# Share of matching cells below which a pattern warns, and below which it fails.
WARN_BELOW = 0.9
FAIL_BELOW = 0.5

ISSUE_TYPE = "array<struct<column_name:string,issue_type:string,severity:string,description:string>>"


def _issue(column: str, kind: str, severity: str, description: Column | str) -> Column:
    text = F.lit(description) if isinstance(description, str) else description
    return F.struct(
        F.lit(column).alias("column_name"),
        F.lit(kind).alias("issue_type"),
        F.lit(severity).alias("severity"),
        text.alias("description"),
    )


def field_states(schema: T.StructType, definition: SchemaDefinition) -> list[tuple[str, str, str]]:
    """(column, issue type, severity) of every field that deviates from the definition; runs no job."""
    actual = {f.name: f.dataType.simpleString() for f in schema.fields}
    found: list[tuple[str, str, str]] = []
    for f in definition.fields:
        if f.name not in actual:
            found.append((f.name, "missing", "warning" if f.nullable else "error"))
        elif not is_compatible(declared_type(f), actual[f.name]):
            found.append((f.name, "type", "error"))
    found += [(name, "extra", "warning") for name in actual if name not in definition.by_name]
    return found


def fields_conform(schema: T.StructType, definition: SchemaDefinition) -> bool:
    """Whether no field deviates in a way that makes the schema invalid."""
    return all(severity != "error" for _, _, severity in field_states(schema, definition))


def check_aggregates(df: DataFrame, definition: SchemaDefinition) -> list[Column]:
    """Pattern hits and extreme values of every constrained column that is there."""
    aggregates = []
    for column, pattern in definition.patterns.items():
        if column in df.columns:
            aggregates.append(F.count_if(cells.pattern_hit(cells.cell(column), pattern)).alias(f"hits {column}"))
    for column, bounds in definition.ranges.items():
        if column in df.columns:
            value = cells.comparable(column, df.schema[column].dataType, *bounds.values())
            aggregates.append(F.min(value).alias(f"low {column}"))
            aggregates.append(F.max(value).alias(f"high {column}"))
    return aggregates


@dataclass(frozen=True)
class Check:
    """A possible issue: it is one where ``condition`` holds, or always where there is no condition."""

    column: str
    kind: str
    severity: str
    text: Column | str
    condition: Column | None = None

    def issue(self) -> Column:
        found = _issue(self.column, self.kind, self.severity, self.text)
        return found if self.condition is None else F.when(self.condition, found)


def checks_of(df: DataFrame, definition: SchemaDefinition) -> list[Check]:
    """All checks of a definition, over a row that holds ``record_count`` and the check aggregates."""
    found = [
        Check(column, kind, severity, f"{kind} field: {column}")
        for column, kind, severity in field_states(df.schema, definition)
    ]
    for column, pattern in definition.patterns.items():
        if column not in df.columns:
            found.append(Check(column, "pattern", "warning", "column is absent, pattern not checked"))
            continue
        share = cells.ratio(F.col(f"`hits {column}`"), F.col("record_count"))
        text = F.concat(F.format_string("%.4f", share), F.lit(f" of the values match {pattern}"))
        found.append(Check(column, "pattern", "warning", text, share < WARN_BELOW))
        found.append(Check(column, "pattern", "error", text, share < FAIL_BELOW))
    for column, bounds in definition.ranges.items():
        if column not in df.columns:
            found.append(Check(column, "range", "warning", "column is absent, range not checked"))
            continue
        low, high = F.col(f"`low {column}`"), F.col(f"`high {column}`")
        found.append(Check(column, "range", "warning", "no values, range not checked", low.isNull()))
        if "min" in bounds:
            text = F.concat(F.lit("least value "), low.cast("string"), F.lit(f" is below {bounds['min']}"))
            found.append(Check(column, "range", "error", text, low < bounds["min"]))
        if "max" in bounds:
            text = F.concat(F.lit("greatest value "), high.cast("string"), F.lit(f" is above {bounds['max']}"))
            found.append(Check(column, "range", "error", text, high > bounds["max"]))
    return found


def result_columns(checks: list[Check]) -> dict[str, Column]:
    """Validity, issue counts and the issues. All extra fields of a dataset together make one warning."""

    def count(severity: str) -> Column:
        always = sum(c.condition is None and c.severity == severity and c.kind != "extra" for c in checks)
        if severity == "warning":
            always += any(c.kind == "extra" for c in checks)
        flags = [cells.as_flag(c.condition) for c in checks if c.condition is not None and c.severity == severity]
        return F.lit(always) + cells.total(flags) if flags else F.lit(always)

    if checks:
        issues = F.filter(F.array(*[c.issue() for c in checks]), lambda issue: issue.isNotNull())
    else:
        issues = F.array()
    return {
        "schema_valid": count("error") == 0,
        "schema_error_count": count("error"),
        "schema_warning_count": count("warning"),
        "issues": issues.cast(ISSUE_TYPE),
    }


def validate(df: DataFrame, definition: SchemaDefinition, by: Sequence[str] = ()) -> DataFrame:
    """Valid flag, issue counts and the list of issues: one row per dataset or per group, one scan."""
    checked = df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"), *check_aggregates(df, definition))
    results = result_columns(checks_of(df, definition))
    return checked.select(*by, "record_count", *[c.alias(name) for name, c in results.items()])


def issue_rows(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per issue."""
    return validated.select(*by, F.explode("issues").alias("issue")).select(*by, "issue.*")


def pattern_validation(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Matches, total, match ratio and severity per pattern, from one scan."""
    present = {c: p for c, p in patterns.items() if c in df.columns}
    counted = df.agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.count_if(cells.pattern_hit(cells.cell(c), p)).alias(f"hits {c}") for c, p in present.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col(f"`hits {c}`") if c in present else F.lit(None).cast("bigint")).alias("match_count"),
            )
            for c in patterns
        ]
    )
    share = cells.ratio(F.col("match_count"), F.col("total_count"))
    severity = (
        F.when(F.col("match_count").isNull(), "warning")
        .when(share < FAIL_BELOW, "error")
        .when(share < WARN_BELOW, "warning")
        .otherwise("ok")
    )
    return (
        counted.select("total_count", F.explode(rows).alias("r"))
        .select("r.column_name", "r.match_count", "total_count")
        .withColumn("match_ratio", F.when(F.col("match_count").isNotNull(), share))
        .withColumn("severity", severity)
    )


def range_validation(df: DataFrame, ranges: dict[str, dict[str, float]]) -> DataFrame:
    """Extreme values per column against its bounds, from one scan; ``in_range`` is null without values."""
    present = [c for c in ranges if c in df.columns]
    found = df.agg(
        F.count(F.lit(1)).alias("record_count"),
        *[
            extreme(cells.comparable(c, df.schema[c].dataType, *ranges[c].values())).cast("double").alias(f"{side} {c}")
            for c in present
            for side, extreme in (("low", F.min), ("high", F.max))
        ],
    )

    def bound(name: str, value) -> Column:
        return F.lit(None if value is None else float(value)).cast("double").alias(name)

    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                bound("lower", ranges[c].get("min")),
                bound("upper", ranges[c].get("max")),
                (F.col(f"`low {c}`") if c in present else F.lit(None).cast("double")).alias("actual_min"),
                (F.col(f"`high {c}`") if c in present else F.lit(None).cast("double")).alias("actual_max"),
            )
            for c in ranges
        ]
    )
    above = F.coalesce(F.col("actual_min") >= F.col("lower"), F.lit(True))
    below = F.coalesce(F.col("actual_max") <= F.col("upper"), F.lit(True))
    return (
        found.select(F.explode(rows).alias("r"))
        .select("r.*")
        .withColumn("in_range", F.when(F.col("actual_min").isNotNull(), above & below))
    )
