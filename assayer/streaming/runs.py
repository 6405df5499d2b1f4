"""Starting streams, sending them to sinks, and telling how they fare."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from assayer.sources.kafka import read_kafka_stream

# How often a stream is triggered, and the output modes there are.
TRIGGER = "10 seconds"
OUTPUT_MODES = ("append", "update", "complete")
SINKS = ("foreachBatch", "console", "memory", "kafka", "parquet")


def read_table_stream(spark: SparkSession, folder: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of parts, as a stream of its files. A table that is not there is an error."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern the path may be a file as well; a plain one would have to be a folder.
    return reader.parquet(f"{folder}/{table}.parque[t]")


def start_sink(
    stream: DataFrame,
    query_name: str,
    checkpoint: str,
    sink: str = "foreachBatch",
    output_mode: str = "append",
    trigger: str | None = TRIGGER,
    handler: Callable[[DataFrame, int], None] | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a query under its own checkpoint folder. ``trigger`` None works off what is there and stops."""
    if output_mode not in OUTPUT_MODES:
        raise ValueError(f"unknown output mode {output_mode!r}")
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}")
    writer = (
        stream.writeStream.outputMode(output_mode)
        .queryName(query_name)
        .option("checkpointLocation", f"{checkpoint}/{query_name}")
        .options(**(options or {}))
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if sink == "foreachBatch":
        if handler is None:
            raise ValueError("foreachBatch needs a handler")
        return writer.foreachBatch(handler).start()
    return writer.format(sink).start()


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query that works off what is there has ended; its failure is raised here."""
    query.awaitTermination()
    return query


def start_streams(
    spark: SparkSession,
    sources: Iterable[Mapping[str, Any]],
    start: Callable[[DataFrame, Mapping[str, Any]], StreamingQuery],
    read: Callable[[SparkSession, Mapping[str, Any]], DataFrame] = read_kafka_stream,
) -> dict[str, StreamingQuery]:
    """A query per enabled source that is marked for streaming, by source name."""
    return {
        s["name"]: start(read(spark, s), s)
        for s in sources
        if s.get("enabled", True) and s.get("streaming_enabled", False)
    }


STATUS_SCHEMA = (
    "query_name string, query_id string, is_active boolean, batch_id bigint, input_rows bigint, "
    "rows_per_second double, late_rows bigint, message string"
)


def stream_status(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """One row per query: whether it runs, its last batch, and rows that came too late for its windows."""
    rows = []
    for q in queries:
        progress = q.lastProgress or {}
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in progress.get("stateOperators", []))
        rows.append(
            (
                q.name,
                str(q.id),
                q.isActive,
                progress.get("batchId"),
                progress.get("numInputRows"),
                progress.get("processedRowsPerSecond"),
                late,
                q.status["message"],
            )
        )
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def run_summary(queries: Mapping[str, StreamingQuery]) -> dict[str, Any]:
    """How many streams run and under which names."""
    return {"streaming_sources": len(queries), "queries": sorted(q.name for q in queries.values())}
