"""Streaming sources from read to write, and all streaming sources of a configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from assayer.operators.scoring import COUNT_COLUMNS
from assayer.operators.tiering import stamp_events
from assayer.plans.batch import Run, grade_source
from assayer.session import cut_lineage
from assayer.sources.config import all_sources, streaming_sources
from assayer.sources.kafka import read_kafka_stream
from assayer.sources.payloads import decode_values, split_decoded
from assayer.streaming.batches import add_stream_columns, overwrite_batch, per_event, write_batches
from assayer.streaming.runs import TRIGGER, start_sink, start_streams
from assayer.streaming.windows import window_counts, with_event_time

Read = Callable[[SparkSession, Mapping[str, Any]], DataFrame]


def grade_and_write_batches(path: str, source: Mapping[str, Any], run: Run) -> Callable[[DataFrame, int], None]:
    """Full treatment of a stream: each micro-batch is evolved, graded as a dataset of its own and written.

    Rows go to ``<path>/rows`` with tier and scores, the counts behind them to ``<path>/counts``, messages
    that could not be decoded to ``<path>/dead_letters``; all by batch id, so that a repeated batch
    replaces itself. The batch is read once: it is counted while it is staged.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if "_corrupt" in batch.columns:
            batch, dead = split_decoded(cut_lineage(batch))
            overwrite_batch(dead, f"{path}/dead_letters", batch_id)
        graded, row = grade_source(batch, source, run, streaming=True)
        if not row["record_count"]:
            return
        graded = add_stream_columns(graded, valid=row["schema_valid"])
        overwrite_batch(graded, f"{path}/rows", batch_id, ("data_classification",))
        counts = {name: row[name] for name in COUNT_COLUMNS}
        counted = batch.sparkSession.createDataFrame(
            [(*counts.values(), row["data_classification"])],
            ", ".join(f"{name} bigint" for name in counts) + ", data_classification string",
        )
        overwrite_batch(counted, f"{path}/counts", batch_id)

    return handle


def start_graded_streams(
    spark: SparkSession,
    config: Mapping[str, Any],
    run: Run,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    window: str | None = None,
    slide: str | None = None,
    read: Read = read_kafka_stream,
) -> dict[str, StreamingQuery]:
    """A query per streaming source, by source name.

    Each micro-batch is graded and written. With ``window`` the stream's events are counted per
    window instead, by their own time where they carry one, else by time of processing.
    """

    def start(stream: DataFrame, source: Mapping[str, Any]) -> StreamingQuery:
        name, target = f"stream-{source['name']}", f"{path}/{source['name']}"
        if source.get("value_schema"):
            stream = decode_values(stream, source["value_schema"], value=source.get("value_column", "value"))
        if window:
            name = f"windows-{source['name']}"
            rows = split_decoded(stream)[0] if "_corrupt" in stream.columns else stream
            stream = window_counts(with_event_time(rows), window, slide)
            handler = write_batches(f"{target}/windows")
        else:
            handler = grade_and_write_batches(target, source, run)
        return start_sink(stream, name, checkpoint, trigger=trigger, handler=handler)

    return start_streams(spark, streaming_sources(config), start, read)


def start_event_streams(
    spark: SparkSession,
    config: Mapping[str, Any],
    callback: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = "1 second",
    read: Read = read_kafka_stream,
    label: str = "events",
    dead_letters: str | None = None,
) -> dict[str, StreamingQuery]:
    """Event mode, for every enabled message source: the decoded events reach ``callback`` batch by batch.

    They carry the source's name and the time of handling. Undecodable messages go to
    ``<dead_letters>/<source>`` by batch if that is given; their number is logged in any case.
    """

    def start(stream: DataFrame, source: Mapping[str, Any]) -> StreamingQuery:
        def stamped(events: DataFrame, batch_id: int) -> None:
            callback(stamp_events(events, source["name"]), batch_id)

        handler = per_event(source["event_schema"], stamped, source.get("value_column", "value"), dead_letters and f"{dead_letters}/{source['name']}")
        return start_sink(stream, f"{label}-{source['name']}", checkpoint, trigger=trigger, handler=handler)

    sources = [s for family, s in all_sources(config) if family == "kafka"]
    return {s["name"]: start(read(spark, s), s) for s in sources}
