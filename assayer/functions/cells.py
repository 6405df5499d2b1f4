"""Predicates on single cells, with the null rule of each one spelled out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def cell(name: str) -> Column:
    """A top-level column, also when its name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_not_a_number(name: str, data_type: T.DataType) -> Column:
    """NaN. Only floating columns can hold it; the string 'NaN' is an ordinary value."""
    if isinstance(data_type, FLOATING):
        return F.coalesce(F.isnan(cell(name)), F.lit(False))
    return F.lit(False)


def is_missing(name: str, data_type: T.DataType) -> Column:
    """Null or NaN."""
    if isinstance(data_type, FLOATING):
        return cell(name).isNull() | F.isnan(cell(name))
    return cell(name).isNull()


def is_empty_text(name: str) -> Column:
    """The empty string; null is not empty."""
    return F.coalesce(cell(name) == "", F.lit(False))


def outside(value: Column, low, high) -> Column:
    """Outside the closed interval; null stays null, so counting ignores it."""
    return ~value.between(low, high)


def lacks(value: Column, pattern: str) -> Column:
    """The pattern occurs nowhere in the cell's text; null stays null."""
    return ~value.cast("string").rlike(pattern)


def not_one_of(value: Column, allowed: Sequence) -> Column:
    """Not among the allowed values; null stays null."""
    return ~value.isin(list(allowed))


def pattern_hit(value: Column, pattern: str) -> Column:
    """The pattern occurs in the cell's text and its match is not empty; null is no hit."""
    return F.coalesce(F.regexp_extract(value.cast("string"), pattern, 0) != "", F.lit(False))


def comparable(name: str, data_type: T.DataType, *values) -> Column:
    """The cell in a form that can be compared with the given values.

    Text is read as a number where the values are numbers; text that is none becomes null.
    """
    if isinstance(data_type, T.StringType) and any(isinstance(v, (int, float, Decimal)) for v in values):
        return cell(name).try_cast("double")
    return cell(name)


def as_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where there is nothing to divide by."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def total(flags: Iterable[Column]) -> Column:
    """Sum of many expressions, nested as a balanced tree so that wide tables do not nest deeply."""
    level = list(flags) or [F.lit(0)]
    while len(level) > 1:
        level = [a + b for a, b in zip(level[::2], level[1::2], strict=False)] + (level[-1:] if len(level) % 2 else [])
    return level[0]


def age_in_days(name: str, data_type: T.DataType, as_of: Column) -> Column:
    """Whole calendar days between the cell and ``as_of``; null where no date can be read.

    Numbers are seconds since 1970.
    """
    value = cell(name)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        day = value.cast("date")
    elif isinstance(data_type, T.NumericType):
        day = F.timestamp_seconds(value).cast("date")
    else:
        day = F.try_to_timestamp(value.cast("string")).cast("date")
    return F.datediff(as_of, day)
