"""What happens to a micro-batch. Every handler may run twice for one batch and leaves the same result."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayer.operators.checks import fields_conform
from assayer.operators.schema import SchemaDefinition
from assayer.operators.latest import latest_per_key
from assayer.operators.scoring import QualitySpec, count_cells, merge_counts, scores_from_counts
from assayer.operators.sketches import merge_sketches, profile_from_sketches, profile_sketches
from assayer.operators.tiering import add_date_parts, classify, moment_column
from assayer.session import list_folders, path_exists, remove_path
from assayer.sinks.tiers import tier_path
from assayer.sources.payloads import parse_value, split_values, value_state
from assayer.streaming.runs import start_sink

log = logging.getLogger(__name__)

Handler = Callable[[DataFrame, int], None]


def overwrite_batch(df: DataFrame, path: str, batch_id: int, parts: Sequence[str] = ()) -> None:
    """Write one batch to its own partition of a table, replacing all that an earlier try left there."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(f"{path}/batch_id={batch_id}")


def write_batches(path: str) -> Handler:
    """Append each batch to a table under its batch id."""
    return lambda batch, batch_id: overwrite_batch(batch, path, batch_id)


def replace_result(path: str) -> Handler:
    """Keep complete results: each batch's is written beside the last one, over the one but last."""
    return lambda batch, batch_id: overwrite_batch(batch.withColumn("__batch", F.lit(batch_id)), path, batch_id % 2)


def read_result(spark: SparkSession, path: str, query: StreamingQuery) -> DataFrame:
    """The result that the last batch of a ``complete`` query left, however many batches there were."""
    try:
        both = spark.read.parquet(path).drop("batch_id")
    except AnalysisException:
        raise ValueError("the stream has not delivered anything") from None
    last = both.agg(F.max("__batch")).first()[0]
    return both.where(F.col("__batch") == last).drop("__batch")


def upsert_result(path: str) -> Handler:
    """Keep the groups that each batch of an ``update`` query changed, under its batch id; see ``read_updates``."""
    return lambda batch, batch_id: overwrite_batch(batch.withColumn("__batch", F.lit(batch_id).cast("bigint")), path, batch_id)


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The result so far of an ``update`` query: of each group (``keys``) the row of the last batch that changed it."""
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(path).drop("batch_id")
    except AnalysisException:
        raise ValueError("the stream has not delivered anything") from None
    return latest_per_key(rows, list(keys), ["__batch"]).select(*(c for c in rows.columns if c != "__batch"))


def fold_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Make one partition of all batches so far, so that reading a result costs what it holds, not what it went through.

    The fold is written beside the batches before these go, and rows keep the number of their batch: a reader in between, a
    fold that breaks off, or a batch that comes again see the same result. To be called while the query is stopped.
    """
    parts = [name for name in list_folders(spark, path) if name.startswith("batch_id=")]
    if not parts:
        return
    rows = spark.read.option("mergeSchema", "true").parquet(path).drop("batch_id")
    last = rows.agg(F.max("__batch")).first()[0]
    if last is None:
        return
    fold = f"batch_id={-1 - last}"
    if not path_exists(spark, f"{path}/{fold}/_SUCCESS"):
        if remove_path(spark, f"{path}/{fold}"):  # of a fold that broke off; the batches are still there
            rows = spark.read.option("mergeSchema", "true").parquet(path).drop("batch_id")
        latest_per_key(rows, list(keys), ["__batch"]).write.parquet(f"{path}/{fold}")
    for name in parts:
        if name != fold:
            remove_path(spark, f"{path}/{name}")


def write_tier_batches(path: str, run_moment: datetime | None = None) -> Handler:
    """Append each batch to a tier table with batch id and integer date parts."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        dated = add_date_parts(batch, moment_column(run_moment))
        overwrite_batch(dated, path, batch_id, ("year", "month", "day"))

    return handle


def grade_batches(path: str, spec: QualitySpec, as_of=None, by: Sequence[str] = ()) -> Handler:
    """Count each batch in one scan and keep the counts, with the batch's own scores and tier.

    Counts, not scores, are what adds up: ``graded_stream`` grades the stream so far from them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = count_cells(batch, spec, as_of, by)
        graded = classify(scores_from_counts(counts, spec, spec.date_column in batch.columns), spec.thresholds)
        overwrite_batch(graded, path, batch_id)

    return handle


def graded_stream(spark: SparkSession, path: str, spec: QualitySpec, by: Sequence[str] = ()) -> DataFrame:
    """Scores and tier of everything the stream has delivered, from the counts of its batches."""
    counts = merge_counts(spark.read.parquet(path), by)
    return classify(scores_from_counts(counts, spec, spec.date_column is not None), spec.thresholds)


def split_batches(schema: str, path: str, value: str = "value") -> Handler:
    """Decode messages in one pass; those that cannot be decoded are kept as dead letters.

    The table has a partition per batch and state (``parsed``, ``dead_letter``, ``empty``), and
    the raw value of dead letters only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = parse_value(batch, schema, value)
        state = value_state(F.col("_raw"), F.col("_corrupt"))
        raw = F.when(F.col("_corrupt").isNotNull(), F.col("_raw"))
        tagged = rows.withColumns({"state": state, value: raw}).drop("_raw", "_corrupt")
        overwrite_batch(tagged, path, batch_id, ("state",))

    return handle


def per_event(schema: str, callback: Callable[[DataFrame, int], None], value: str = "value", dead_path: str | None = None) -> Handler:
    """Hand the decoded events of a batch on as a frame; undecodable ones are written to ``dead_path`` or counted in the log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_values(batch, schema, value)
        if dead_path:
            overwrite_batch(bad, dead_path, batch_id)
        else:
            log.warning("batch %s: %s messages could not be decoded", batch_id, bad.count())
        callback(good, batch_id)

    return handle


def batch_stats(path: str) -> Handler:
    """Row count of each batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        overwrite_batch(batch.agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0"), path, batch_id)

    return handle


def add_stream_columns(df: DataFrame, definition: SchemaDefinition | None = None, valid: bool = True) -> DataFrame:
    """Schema flag and times of handling.

    On a stream the flag comes from its columns and needs no job; for a batch whose values were
    checked it is given.
    """
    if definition is not None:
        valid = fields_conform(df.schema, definition)
    added = {"_schema_valid": F.lit(valid), "_quality_check_time": F.current_timestamp()}
    if "_processing_time" not in df.columns:
        added["_processing_time"] = F.current_timestamp()
    return df.withColumns(added)


def write_tier_stream_files(
    stream: DataFrame,
    tier: str,
    source_name: str,
    target_paths: dict[str, str],
    query_name: str,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Append a stream to tier files; Spark's file sink writes each batch exactly once."""
    tagged = stream.withColumn("classification_level", F.lit(tier))
    return start_sink(
        tagged,
        query_name,
        checkpoint,
        sink="parquet",
        trigger=trigger,
        options={"path": tier_path(target_paths, tier, source_name)},
    )


def sketch_batches(path: str, columns: Sequence[str] | None = None) -> Handler:
    """Keep the profile sketches of each batch; ``profiled_stream`` merges them."""
    return lambda batch, batch_id: overwrite_batch(profile_sketches(batch, columns), path, batch_id)


def profiled_stream(spark: SparkSession, path: str) -> DataFrame:
    """The profile of everything the stream has delivered, from the sketches of its batches."""
    return profile_from_sketches(merge_sketches(spark.read.parquet(path)))
