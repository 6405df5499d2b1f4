"""Queries that run a stream over the event table until all of it is worked off."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.checks import fields_conform
from assayer.plans import views
from assayer.plans.batch import Run
from assayer.plans.catalog import register
from assayer.plans.definitions import CUSTOMER_V1, CUSTOMER_V2
from assayer.plans.live import grade_and_write_batches, start_event_streams, start_graded_streams
from assayer.plans.scores import FEED_SCORES, FEED_SPEC, PROFILE_SQL, PROFILED, TIER_SQL, profiled_events, rounded_tiers, within_error
from assayer.plans.views import AS_OF, CUSTOMER_SRC, DECLARED_FIELDS, EVENT_SRC, RUN_AT
from assayer.session import fresh_path
from assayer.sources.payloads import decode_values, value_state
from assayer.streaming import batches, progress, schema_changes, windows
from assayer.streaming.progress import ProgressLog
from assayer.streaming.runs import read_table_stream, run_available, start_sink

TUMBLING_SQL = """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n,
 round(sum(value), 4) AS total FROM events GROUP BY date_trunc('day', ts)"""
SLIDING_SQL = """SELECT window_start, count(*) AS n FROM (
 SELECT CASE WHEN hour(ts) >= 12 THEN date_trunc('day', ts) + INTERVAL 12 HOUR ELSE date_trunc('day', ts) END AS window_start FROM events
 UNION ALL SELECT CASE WHEN hour(ts) >= 12 THEN date_trunc('day', ts) ELSE date_trunc('day', ts) - INTERVAL 12 HOUR END FROM events) q
 GROUP BY window_start"""


def query_name(label: str) -> str:
    return f"{label}-{uuid.uuid4().hex}"


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.with_event_time(read_table_stream(spark, sf_dir, "events"), "ts")


def tumbling(events: DataFrame) -> DataFrame:
    return windows.window_counts(events, "1 day", aggregates={"total": F.round(F.sum("value"), 4)})


def sliding(events: DataFrame) -> DataFrame:
    return windows.window_counts(events, "1 day", "12 hours").drop("window_end")


@register("tumbling_counts", TUMBLING_SQL)
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling(windows.with_event_time(views.table(spark, sf_dir, "events"), "ts"))


@register("sliding_counts", SLIDING_SQL)
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding(windows.with_event_time(views.table(spark, sf_dir, "events"), "ts"))


def complete_result(spark: SparkSession, result: DataFrame, label: str) -> DataFrame:
    """Run a windowed stream to its end and read the complete result it wrote."""
    path = fresh_path(spark, label)
    query = start_sink(
        result, query_name(label), fresh_path(spark, "checkpoint"), output_mode="complete", trigger=None,
        handler=batches.replace_result(path),
    )
    return batches.read_result(spark, path, run_available(query))


@register("stream_tumbling", TUMBLING_SQL)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_result(spark, tumbling(events_stream(spark, sf_dir)), "tumbling")


@register("stream_sliding", SLIDING_SQL)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_result(spark, sliding(events_stream(spark, sf_dir)), "sliding")


@register("stream_processing_time", "SELECT event_type, count(*) AS n, true AS seen_now FROM events GROUP BY event_type")
def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted in windows of the time at which they are handled, by a query that a processing-time trigger starts anew
    until its files are worked off. All of these windows lie at or after the start of the query."""
    path, name = fresh_path(spark, "processing-time"), query_name("processing-time")
    begun = datetime.now(timezone.utc)
    stream = windows.with_event_time(read_table_stream(spark, sf_dir, "events", files_per_trigger=1))
    counted = windows.window_counts(stream, "1 hour", by=("event_type",))
    query = start_sink(
        counted, name, fresh_path(spark, "checkpoint"), output_mode="complete", trigger="1 second", handler=batches.replace_result(path)
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    now = F.col("window_end") > F.lit(begun).cast("timestamp_ntz")
    return batches.read_result(spark, path, query).groupBy("event_type").agg(F.sum("n").alias("n"), F.min(now).alias("seen_now"))


@register(
    "stream_late_data",
    """SELECT date_trunc('day', ts) AS window_start, count(*) AS n FROM events
 WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
   AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
 GROUP BY date_trunc('day', ts)""",
)
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the first half arrive after those of the second: all of them are behind the watermark."""
    landed, checkpoint, path = (fresh_path(spark, label) for label in ("landed", "checkpoint", "late"))
    events = views.table(spark, sf_dir, "events")
    name = query_name("late")
    for wave in (F.col("ts") >= "2024-01-15", F.col("ts") < "2024-01-15"):
        events.where(wave).write.mode("append").parquet(landed)
        stream = windows.with_event_time(spark.readStream.schema(events.schema).parquet(landed), "ts")
        counted = windows.window_counts(stream, "1 day", delay="1 day").drop("window_end")
        run_available(start_sink(counted, name, checkpoint, trigger=None, handler=batches.write_batches(path)))
    return spark.read.parquet(path).drop("batch_id")


@register("stream_file_sink", "SELECT event_id, event_type, 'silver' AS classification_level FROM events")
def stream_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = {"silver": fresh_path(spark, "silver")}
    stream = read_table_stream(spark, sf_dir, "events").select("event_id", "event_type")
    run_available(
        batches.write_tier_stream_files(
            stream, "silver", "user_events", folders, query_name("files"), fresh_path(spark, "checkpoint")
        )
    )
    return spark.read.parquet(f"{folders['silver']}/user_events")


@register("stream_table_sink", "SELECT event_id, event_type, 2024 AS year, 2 AS month, 1 AS day FROM events")
def stream_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "stream-table")
    stream = read_table_stream(spark, sf_dir, "events").select("event_id", "event_type")
    run_available(
        start_sink(
            stream, query_name("table"), fresh_path(spark, "checkpoint"), trigger=None,
            handler=batches.write_tier_batches(path, RUN_AT),
        )
    )
    return spark.read.parquet(path).drop("batch_id")


@register(
    "stream_tiering",
    f"""SELECT source_name, round(c, 6) AS completeness, round(a, 6) AS accuracy, round(t, 6) AS timeliness,
 {TIER_SQL} AS data_classification FROM {FEED_SCORES}""",
)
def stream_tiering(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "graded")
    feed = views.as_event_src(read_table_stream(spark, sf_dir, "events"))
    run_available(
        start_sink(
            feed, query_name("tiering"), fresh_path(spark, "checkpoint"), trigger=None,
            handler=batches.grade_batches(path, FEED_SPEC, AS_OF, ["source_name"]),
        )
    )
    return rounded_tiers(batches.graded_stream(spark, path, FEED_SPEC, ["source_name"]))


@register(
    "stream_dead_letter",
    f"""SELECT count(*) FILTER (WHERE payload = 'not json') AS dead_letter, count(*) FILTER (WHERE payload <> 'not json') AS parsed,
 count(*) FILTER (WHERE payload IS NULL) AS empty_value FROM {EVENT_SRC}""",
)
def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "messages")
    feed = views.as_event_src(read_table_stream(spark, sf_dir, "events"))
    run_available(
        start_sink(
            feed, query_name("messages"), fresh_path(spark, "checkpoint"), trigger=None,
            handler=batches.split_batches("k int", path, "payload"),
        )
    )
    return spark.read.parquet(path).agg(
        F.count_if(F.col("state") == "dead_letter").alias("dead_letter"),
        F.count_if(F.col("state") == "parsed").alias("parsed"),
        F.count_if(F.col("state") == "empty").alias("empty_value"),
    )


@register("stream_batch_stats", "SELECT count(*) AS row_count FROM events")
def stream_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "batch-stats")
    run_available(
        start_sink(
            read_table_stream(spark, sf_dir, "events"), query_name("stats"), fresh_path(spark, "checkpoint"),
            trigger=None, handler=batches.batch_stats(path),
        )
    )
    return spark.read.parquet(path).agg(F.sum("row_count").alias("row_count"))


@register(
    "stream_columns",
    f"""SELECT customer_id, true AS fits_v1, false AS fits_v2 FROM {CUSTOMER_SRC}""",
)
def stream_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema flags of a stream's records: the feed fits the first version of its schema, not the second."""
    path = fresh_path(spark, "flagged")
    feed = views.as_customer_src(read_table_stream(spark, sf_dir, "customer"))
    first = batches.add_stream_columns(feed, CUSTOMER_V1).withColumnRenamed("_schema_valid", "fits_v1")
    second = first.withColumn("fits_v2", F.lit(fields_conform(feed.schema, CUSTOMER_V2)))
    run_available(
        start_sink(second, query_name("flags"), fresh_path(spark, "checkpoint"), trigger=None, handler=batches.write_batches(path))
    )
    return spark.read.parquet(path).select("customer_id", "fits_v1", "fits_v2")


@register(
    "stream_event_mode",
    f"""SELECT event_id, 'user_events' AS source_name, CAST(json_extract_string(payload, '$.k') AS INT) AS k FROM {EVENT_SRC}
 WHERE payload IS NULL OR payload <> 'not json'""",
)
def stream_event_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "events")
    config = {"kafka_sources": [{"name": "user_events", "event_schema": "k int", "value_column": "payload"}]}
    started = start_event_streams(
        spark,
        config,
        lambda events, batch_id: batches.overwrite_batch(events.select("event_id", "source_name", "k"), path, batch_id),
        fresh_path(spark, "checkpoint"),
        trigger=None,
        read=lambda spark, _: views.as_event_src(read_table_stream(spark, sf_dir, "events")),
        label=uuid.uuid4().hex,
    )
    for query in started.values():
        run_available(query)
    return spark.read.parquet(path).drop("batch_id")


@register(
    "stream_full_grading",
    f"""WITH m AS (SELECT count(*) AS n, 1.0e0 - sum(CASE WHEN payload IS NULL THEN 1 ELSE 0 END) / (count(*) * 5.0e0) AS c,
  1.0e0 - count(*) FILTER (WHERE NOT (value BETWEEN 1 AND 100)) / (count(*) * 5.0e0) AS a,
  greatest(0.0e0, least(1.0e0, 1.0e0 - avg(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01')) / 60)) AS t FROM {EVENT_SRC})
 SELECT event_id, {TIER_SQL} AS data_classification, round(c, 6) AS metric_completeness, true AS schema_valid FROM {EVENT_SRC}, m""",
)
def stream_full_grading(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "full")
    source = {
        "name": "feeds",
        "validation_rules": {"value": {"min": 1, "max": 100}},
        "datetime_column": "ts",
        "classification_rules": {"timeliness": 60},
    }
    run_available(
        start_sink(
            views.as_event_src(read_table_stream(spark, sf_dir, "events")),
            query_name("full"),
            fresh_path(spark, "checkpoint"),
            trigger=None,
            handler=grade_and_write_batches(path, source, Run("run-1", RUN_AT)),
        )
    )
    return spark.read.parquet(f"{path}/rows").select(
        "event_id", "data_classification", F.round("metric_completeness", 6).alias("metric_completeness"), "schema_valid"
    )


SCHEMA_CHANGES_SQL = f"""WITH d AS (SELECT * FROM {DECLARED_FIELDS}),
 v AS (SELECT schema_name, version, lag(version) OVER (PARTITION BY schema_name ORDER BY version) AS old FROM (SELECT DISTINCT schema_name, version FROM d)),
 l AS (SELECT v.schema_name, v.version, d.name, d.type, d.nullable FROM v JOIN d ON d.schema_name = v.schema_name AND d.version = v.old),
 r AS (SELECT schema_name, version, name, type, nullable FROM d)
 SELECT coalesce(l.schema_name, r.schema_name) AS schema_name, coalesce(l.version, r.version) AS version, coalesce(l.name, r.name) AS field,
  CASE WHEN l.name IS NULL THEN 'add' WHEN r.name IS NULL THEN 'remove' ELSE 'modify' END AS change
 FROM l FULL OUTER JOIN r ON l.schema_name = r.schema_name AND l.version = r.version AND l.name = r.name
 WHERE l.name IS NULL OR r.name IS NULL OR l.type <> r.type OR l.nullable <> r.nullable"""


@register("stream_schema_changes", SCHEMA_CHANGES_SQL)
def stream_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema versions land in three waves; each new one is compared with the version before it."""
    return changes_of_waves(spark, sf_dir, (F.col("version") <= 6, F.col("version").between(7, 9), F.col("version") > 9))


@register("stream_schema_changes_late", SCHEMA_CHANGES_SQL)
def stream_schema_changes_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from waves that land out of order: late versions correct the events of those after them."""
    return changes_of_waves(spark, sf_dir, (F.col("version").between(7, 9), F.col("version") % 2 == 0, F.lit(True)))


def changes_of_waves(spark: SparkSession, sf_dir: str, waves: Sequence[Column]) -> DataFrame:
    """Changed fields of all declared versions, which land wave by wave, each version in the first that it fits."""
    landed, checkpoint, known, events = (fresh_path(spark, label) for label in ("schemas", "checkpoint", "registry", "changes"))
    definitions = (
        views.declared_fields(spark, sf_dir)
        .groupBy("schema_name", "version")
        .agg(F.array_sort(F.collect_list(F.struct("name", "type", "nullable"))).alias("fields"))
        .select("version", F.to_json(F.struct(F.col("schema_name").alias("name"), "version", "fields")).alias("value"))
    )
    name = query_name("schemas")
    for number, wave in enumerate(waves):
        earlier = reduce(or_, waves[:number], F.lit(False))
        definitions.where(wave & ~earlier).select("value").write.mode("append").text(landed)
        run_available(
            start_sink(
                schema_changes.schema_file_stream(spark, landed, "*.txt", one_per_file=False),
                name,
                checkpoint,
                trigger=None,
                handler=schema_changes.record_schema_changes(known, events),
            )
        )
    return schema_changes.changed_fields(spark.read.parquet(events))


@register("stream_small_batches", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table kept as a folder of parts, streamed a few files at a time."""
    folder, path = fresh_path(spark, "tables"), fresh_path(spark, "small")
    views.table(spark, sf_dir, "events").repartition(7).write.parquet(f"{folder}/events.parquet")
    run_available(
        start_sink(
            read_table_stream(spark, folder, "events", files_per_trigger=2), query_name("small"), fresh_path(spark, "checkpoint"),
            trigger=None, handler=batches.write_batches(path),
        )
    )
    rows = spark.read.parquet(path)
    if rows.select("batch_id").distinct().count() < 2:
        raise ValueError("all parts came in one batch")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@register(
    "message_accounting",
    f"""SELECT count(*) FILTER (WHERE payload = 'not json') AS dead, count(*) FILTER (WHERE payload <> 'not json') AS parsed, count(*) FILTER (WHERE payload IS NULL) AS empty,
 count(*) FILTER (WHERE payload = 'not json') AS dead_in_stream, count(*) FILTER (WHERE payload IS NULL OR payload <> 'not json') AS rows_in_stream FROM {EVENT_SRC}""",
)
def message_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is parsed, dead or empty, whether it is read as a batch or as a graded stream."""
    source = {"name": "messages", "streaming_enabled": True, "value_schema": "k int", "value_column": "payload"}
    decoded = decode_values(views.event_src(spark, sf_dir), "k int", "payload")
    state = value_state(F.col("_raw"), F.col("_corrupt"))
    batch = decoded.agg(F.count_if(state == "dead_letter").alias("dead"), F.count_if(state == "parsed").alias("parsed"), F.count_if(state == "empty").alias("empty"))
    path = fresh_path(spark, "messages")
    started = start_graded_streams(
        spark, {"kafka_sources": [source]}, Run("run-1", RUN_AT), path, fresh_path(spark, "checkpoint"), trigger=None,
        read=lambda spark, _: views.as_event_src(read_table_stream(spark, sf_dir, "events")),
    )
    run_available(started["messages"])
    dead = spark.read.parquet(f"{path}/messages/dead_letters").count()
    rows = spark.read.parquet(f"{path}/messages/rows").count()
    return batch.withColumns({"dead_in_stream": F.lit(dead).cast("bigint"), "rows_in_stream": F.lit(rows).cast("bigint")})


def parts_of(events: DataFrame, folder: str, which: range) -> None:
    """Some of seven parts of the events, as files that a stream takes up one by one."""
    for i in which:
        events.where(F.pmod(F.col("event_id"), F.lit(7)) == i).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


@register("stream_update", TUMBLING_SQL)
def stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only changed windows leave an update query; after many batches, a fold and a restart they make up the complete result."""
    folder, path, checkpoint, name = fresh_path(spark, "tables"), fresh_path(spark, "updates"), fresh_path(spark, "checkpoint"), query_name("update")
    events, keys = views.table(spark, sf_dir, "events"), ["window_start", "window_end"]
    for which in (range(4), range(4, 7)):
        parts_of(events, folder, which)
        stream = windows.with_event_time(read_table_stream(spark, folder, "events", files_per_trigger=1), "ts")
        counted = windows.window_counts(stream, "1 day", delay="1000 days", aggregates={"sum": F.sum("value")})
        run_available(start_sink(counted, name, checkpoint, output_mode="update", trigger=None, handler=batches.upsert_result(path)))
        if which.start == 0:
            batches.fold_updates(spark, path, keys)
    return batches.read_updates(spark, path, keys).select(*keys, "n", F.round("sum", 4).alias("total"))


@register(
    "stream_progress",
    """SELECT 'by type' AS query, 2::BIGINT AS runs, 0::BIGINT AS failures, 7::BIGINT AS batches, count(*) AS input_rows FROM events
 UNION ALL SELECT 'broken', 1, 1, 0, 0""",
)
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress table accounts for all rows of a stream that was started twice, and for one that failed."""
    folder, path, checkpoint, log = fresh_path(spark, "tables"), fresh_path(spark, "small"), fresh_path(spark, "checkpoint"), fresh_path(spark, "progress")
    events, names, queries = views.table(spark, sf_dir, "events"), {query_name("counted"): "by type", query_name("broken"): "broken"}, []

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise ValueError("this sink takes nothing")

    listener = ProgressLog(spark, log, rows_at_once=5)
    spark.streams.addListener(listener)
    try:
        for which in (range(3), range(3, 7)):
            parts_of(events, folder, which)
            for name, handler in zip(names, (batches.write_batches(path), fail), strict=True):
                if handler is fail and which.start:
                    continue
                queries.append(start_sink(read_table_stream(spark, folder, "events", files_per_trigger=1), name, checkpoint, trigger=None, handler=handler))
                try:
                    run_available(queries[-1])
                except StreamingQueryException:
                    if handler is not fail:
                        raise
        listener.close(queries)
    finally:
        spark.streams.removeListener(listener)
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    named = progress.read_progress(spark, log).groupBy("query_id").agg(F.max("query_name").alias("name"))
    found = progress.progress_summary(progress.read_progress(spark, log)).drop("query_name").join(named, "query_id")
    return found.select(label[F.col("name")].alias("query"), "runs", "failures", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("batches", "input_rows")))


@register("stream_profile", PROFILE_SQL)
def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a stream, from the sketches of its batches."""
    folder, path, events = fresh_path(spark, "tables"), fresh_path(spark, "sketches"), views.table(spark, sf_dir, "events")
    parts_of(events, folder, range(7))
    stream = profiled_events(read_table_stream(spark, folder, "events", files_per_trigger=2))
    run_available(start_sink(stream, query_name("profile"), fresh_path(spark, "checkpoint"), trigger=None, handler=batches.sketch_batches(path, PROFILED)))
    return within_error(batches.profiled_stream(spark, path), profiled_events(events))
