"""Per-column statistics of a dataset as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions import cells


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "exact") -> DataFrame:
    """One row per column: nulls, NaN, empties, extremes, completeness, distinct values.

    Everything but the exact distinct count comes from one aggregate scan. ``distinct`` is
    ``exact`` (a second job that shuffles each distinct value once), ``approx`` (a sketch inside
    the first scan, no shuffle of values) or ``none``. Null is one distinct value.
    """
    fields = [df.schema[name] for name in columns or df.columns]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    aggregates = [F.count(F.lit(1)).alias("record_count")]
    for f in fields:
        value = cells.cell(f.name)
        aggregates.append(F.count(value).alias(f"filled {f.name}"))
        if f.name in numbers:
            aggregates += [
                F.count_if(cells.is_not_a_number(f.name, f.dataType)).alias(f"nan {f.name}"),
                F.min(value).cast("double").alias(f"low {f.name}"),
                F.max(value).cast("double").alias(f"high {f.name}"),
            ]
        if f.name in texts:
            aggregates.append(F.count_if(cells.is_empty_text(f.name)).alias(f"empty {f.name}"))
            if distinct == "approx":
                sketch = F.approx_count_distinct(value) + F.max(cells.as_flag(value.isNull()))
                aggregates.append(sketch.cast("bigint").alias(f"distinct {f.name}"))

    def part(prefix: str, name: str, there: bool, kind: str):
        return F.col(f"`{prefix} {name}`").cast(kind) if there else F.lit(None).cast(kind)

    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"`filled {f.name}`").alias("non_null_count"),
                part("nan", f.name, f.name in numbers, "bigint").alias("nan_count"),
                part("empty", f.name, f.name in texts, "bigint").alias("empty_count"),
                part("low", f.name, f.name in numbers, "double").alias("min_value"),
                part("high", f.name, f.name in numbers, "double").alias("max_value"),
                part("distinct", f.name, f.name in texts and distinct == "approx", "bigint").alias("distinct_count"),
            )
            for f in fields
        ]
    )
    profile = (
        df.agg(*aggregates)
        .select("record_count", F.explode(rows).alias("r"))
        .select("r.column_name", "record_count", "r.non_null_count", "r.nan_count", "r.empty_count",
                "r.min_value", "r.max_value", "r.distinct_count")
    )
    if distinct == "exact" and texts:
        profile = profile.drop("distinct_count").join(distinct_counts(df, texts), "column_name", "left")
    return profile.select(
        "column_name",
        "record_count",
        (F.col("record_count") - F.col("non_null_count")).alias("null_count"),
        "non_null_count",
        "nan_count",
        "empty_count",
        "distinct_count",
        "min_value",
        "max_value",
        cells.ratio(F.col("non_null_count"), F.col("record_count")).alias("completeness"),
        F.when(
            F.col("distinct_count").isNotNull(), cells.ratio(F.col("distinct_count"), F.col("non_null_count"))
        ).alias("cardinality_ratio"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per text column, null included.

    Rows become (column, value) pairs that each task de-duplicates before the shuffle, so a
    value that fills a third of a column is sent once per task.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), cells.cell(c).alias("value")) for i, c in enumerate(columns)])
    counts = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.position", "p.value")  # the position, not the name: it travels with every value
        .distinct()
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("distinct_count"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return counts.select(F.element_at(names, F.col("position") + 1).alias("column_name"), "distinct_count")


def field_frequencies(df: DataFrame) -> DataFrame:
    """The fields of a dataset with type, nullability and the share of records that fill them."""
    fields = df.schema.fields
    shares = df.agg(
        F.count(F.lit(1)).alias("record_count"), *[F.count(cells.cell(f.name)).alias(f"filled {f.name}") for f in fields]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                cells.ratio(F.col(f"`filled {f.name}`"), F.col("record_count")).alias("frequency"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return shares.select(F.explode(rows).alias("r")).select("r.*")


def preview(df: DataFrame, rows: int = 5, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(row count, column count and schema text; the first rows), the latter in an order or as they come."""
    info = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(df.schema.simpleString()).alias("schema_text"),
    )
    return info, (df.orderBy(*order) if order else df).limit(rows)
