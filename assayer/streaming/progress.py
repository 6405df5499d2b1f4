"""What streams have done, batch by batch, as a table."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query_name string, query_id string, run_id string, batch_id bigint, event string, happened_at string, input_rows bigint, "
    "rows_per_second double, late_rows bigint, state_rows bigint, watermark string, duration_ms bigint, message string"
)


class ProgressLog(StreamingQueryListener):
    """Writes every batch's progress, and how each run ended, to the table at ``path``.

    Events arrive on the driver's listener thread, which only keeps them; a thread of its own writes ``rows_at_once`` of
    them at a time, so that no more are held however long a stream runs. ``close`` waits for the end of the given queries and
    writes the rest. A failed run is a row with its message.
    """

    def __init__(self, spark: SparkSession, path: str, rows_at_once: int = 500):
        self.spark, self.path, self.rows_at_once = spark, path, rows_at_once
        self._rows: list[tuple] = []
        self._names: dict[str, str | None] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        self._pool = ThreadPoolExecutor(max_workers=1)
        self._writes: list[Future] = []

    def onQueryStarted(self, event) -> None:
        self._keep((event.name, str(event.id), str(event.runId), None, "started", event.timestamp, None, None, None, None, None, None, None))
        with self._changed:
            self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        held = sum(s.numRowsTotal for s in p.stateOperators)
        rate = p.processedRowsPerSecond
        self._keep((
            p.name, str(p.id), str(p.runId), p.batchId, "progress", p.timestamp, p.numInputRows, float(rate) if rate == rate else None, late, held,
            (p.eventTime or {}).get("watermark"), (p.durationMs or {}).get("triggerExecution"), None,
        ))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        message = event.exception.split("\n", 1)[0] if event.exception else None
        with self._changed:
            name = self._names.pop(run, None)
        self._keep((name, str(event.id), run, None, "failed" if event.exception else "ended", None, None, None, None, None, None, None, message))
        with self._changed:
            self._ended.add(run)
            self._changed.notify_all()

    def _keep(self, row: tuple) -> None:
        with self._changed:
            self._rows.append(row)
            if len(self._rows) >= self.rows_at_once:
                self._flush()

    def _flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self._writes = [w for w in self._writes if not w.done() or w.exception()] + [self._pool.submit(self._write, rows)]

    def _write(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.parquet(f"{self.path}/part=p-{uuid.uuid4().hex}")

    def close(self, queries: Iterable[StreamingQuery] = (), timeout: float = 60.0) -> None:
        """Write all that is known once ``queries`` have ended; what could not be written is raised."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            self._changed.wait_for(lambda: runs <= self._ended, timeout)
            self._flush()
            writes, self._writes = self._writes, []
        for write in writes:
            write.result()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a progress table; none before the first."""
    try:
        return spark.read.schema(PROGRESS_SCHEMA).parquet(path).select(*(c.split()[0] for c in PROGRESS_SCHEMA.split(", ")))
    except AnalysisException:
        return spark.createDataFrame([], PROGRESS_SCHEMA)


def progress_summary(progress: DataFrame) -> DataFrame:
    """One row per query over all its runs: batches, input and late rows, failures, last batch.

    A batch that came again after a restart counts as it went last; ``batches`` are those that had input.
    """
    done = progress.where("event = 'progress'").groupBy("query_id", "batch_id").agg(
        F.max_by(F.struct("query_name", "input_rows", "late_rows"), "happened_at").alias("last"))
    counted = done.groupBy("query_id").agg(
        F.max("last.query_name").alias("query_name"), F.count_if(F.col("last.input_rows") > 0).alias("batches"), F.sum("last.input_rows").alias("input_rows"),
        F.sum("last.late_rows").alias("late_rows"), F.max("batch_id").alias("last_batch"))
    ends = progress.groupBy("query_id").agg(
        F.count_if(F.col("event") == "started").alias("runs"), F.count_if(F.col("event") == "failed").alias("failures"), F.max("message").alias("message"))
    return ends.join(counted, "query_id", "left")
