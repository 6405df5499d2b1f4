"""Windowed aggregates of event streams; the same functions serve batch frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_TIME = "_event_time"
PROCESSING_TIME = "_processing_time"


def with_event_time(df: DataFrame, column: str | None = None) -> DataFrame:
    """Add the time that windows use: the event's own, else the time of processing.

    Watermarks need a timestamp with a zone, so times without one are taken as session time.
    """
    if column is None and EVENT_TIME in df.columns:
        column = EVENT_TIME
    if column is None:
        return df.withColumn(EVENT_TIME, F.current_timestamp())
    return df.withColumn(EVENT_TIME, F.col(column).cast(T.TimestampType()))


def window_counts(
    events: DataFrame,
    duration: str,
    slide: str | None = None,
    delay: str | None = None,
    aggregates: Mapping[str, Column] | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows per tumbling (or, with ``slide``, sliding) window, plus any further aggregates.

    The watermark lags by the window's length unless said otherwise; events older than it are
    dropped. Windows are state of the stream, one row each, so a busy window is not a hot spot:
    tasks count their share before the shuffle.
    """
    further = [a.alias(name) for name, a in (aggregates or {}).items()]
    window = F.window(EVENT_TIME, duration, slide) if slide else F.window(EVENT_TIME, duration)
    marked = events.withWatermark(EVENT_TIME, delay or duration) if events.isStreaming else events
    return (
        marked.groupBy(window.alias("window"), *by)
        .agg(F.count(F.lit(1)).alias("n"), *further)
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            *by,
            "n",
            *(aggregates or {}),
        )
    )
