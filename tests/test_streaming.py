from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from assayer.operators import scoring, tiering
from assayer.operators.schema import definition_to_json, evolve_definition
from assayer.operators.scoring import QualitySpec
from assayer.plans import views
from assayer.plans.batch import Run
from assayer.plans.live import grade_and_write_batches, start_event_streams, start_graded_streams
from assayer.plans.definitions import CUSTOMER_V1, CUSTOMER_V2
from assayer.plans.scores import FEED_SPEC
from assayer.streaming import batches, runs, schema_changes, windows

AS_OF = dt.date(2024, 2, 1)


@pytest.fixture
def landed(spark, sf_dir, tmp_path):
    """The events in four files, so that a stream takes several batches."""
    path = str(tmp_path / "events")
    views.table(spark, sf_dir, "events").repartition(4, "event_id").write.parquet(path)
    return path


def event_stream(spark, path, files_per_trigger=1):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def name():
    return f"q-{uuid.uuid4().hex}"


def run(stream, tmp_path, handler, query=None, **options):
    query = runs.start_sink(stream, query or name(), str(tmp_path / "checkpoint"), trigger=None, handler=handler, **options)
    return runs.run_available(query)


def test_batches_of_a_stream_add_up_to_the_batch_result(spark, sf_dir, landed, tmp_path):
    feed = views.as_event_src(event_stream(spark, landed))
    path = str(tmp_path / "graded")
    query = run(feed, tmp_path, batches.grade_batches(path, FEED_SPEC, AS_OF, ["source_name"]))
    assert spark.read.parquet(path).select("batch_id").distinct().count() == 4
    streamed = {r["source_name"]: r for r in batches.graded_stream(spark, path, FEED_SPEC, ["source_name"]).collect()}
    whole = {r["source_name"]: r for r in tiering.tier(views.event_src(spark, sf_dir), FEED_SPEC, AS_OF, ["source_name"]).collect()}
    for source, row in whole.items():
        for column in (*scoring.COUNT_COLUMNS, *scoring.SCORE_COLUMNS, "data_classification"):
            assert streamed[source][column] == row[column]
    status = runs.stream_status(spark, [query]).first()
    assert (status["is_active"], status["batch_id"]) == (False, 3)


def test_a_repeated_batch_leaves_one_result(spark, sf_dir, tmp_path):
    events = views.table(spark, sf_dir, "events")
    for handler, path in (
        (batches.write_batches(str(tmp_path / "a")), tmp_path / "a"),
        (batches.write_tier_batches(str(tmp_path / "b"), dt.datetime(2024, 2, 1)), tmp_path / "b"),
        (batches.split_batches("k int", str(tmp_path / "c"), "props"), tmp_path / "c"),
    ):
        handler(events, 0)
        handler(events, 0)
        handler(events.where("false"), 1)
        assert spark.read.parquet(str(path)).count() == 1000


def test_a_batch_that_comes_out_differently_replaces_all_of_itself(spark, tmp_path):
    path = str(tmp_path / "p")
    batches.overwrite_batch(spark.range(4).withColumn("part", F.col("id") % 2), path, 3, ("part",))
    batches.overwrite_batch(spark.range(1).withColumn("part", F.lit(7)), path, 3, ("part",))
    assert [tuple(r) for r in spark.read.parquet(path).select("id", "batch_id", "part").collect()] == [(0, 3, 7)]


def test_restart_goes_on_where_the_stream_stopped(spark, sf_dir, tmp_path):
    events, path, source, query = views.table(spark, sf_dir, "events"), str(tmp_path / "out"), str(tmp_path / "in"), name()
    for part in (F.col("event_id") < 400, F.col("event_id") >= 400):
        events.where(part).write.mode("append").parquet(source)
        run(event_stream(spark, source, 100), tmp_path, batches.write_batches(path), query)
    rows = spark.read.parquet(path)
    assert rows.count() == 1000
    assert rows.select("event_id").distinct().count() == 1000
    assert rows.select("batch_id").distinct().count() >= 2


def test_windows_equal_the_batch_result_in_complete_mode(spark, sf_dir, landed, tmp_path):
    stream = windows.with_event_time(event_stream(spark, landed), "ts")
    path = str(tmp_path / "w")
    query = run(windows.window_counts(stream, "1 day", "12 hours"), tmp_path, batches.replace_result(path), output_mode="complete")
    streamed = batches.read_result(spark, path, query)
    whole = windows.window_counts(windows.with_event_time(views.table(spark, sf_dir, "events"), "ts"), "1 day", "12 hours")
    assert streamed.exceptAll(whole).count() == whole.exceptAll(streamed).count() == 0
    assert whole.count() == 61


def test_append_mode_gives_closed_windows_only(spark, sf_dir, tmp_path):
    stream = windows.with_event_time(runs.read_table_stream(spark, sf_dir, "events"), "ts")
    path = str(tmp_path / "w")
    run(windows.window_counts(stream, "1 day"), tmp_path, batches.write_batches(path))
    closed = spark.read.parquet(path)
    assert (closed.count(), closed.agg(F.sum("n")).first()[0]) == (28, 937)


def test_update_mode_gives_each_change(spark, landed, tmp_path):
    stream = windows.with_event_time(event_stream(spark, landed), "ts")
    path = str(tmp_path / "w")
    run(windows.window_counts(stream, "1 day", delay="60 days"), tmp_path, batches.write_batches(path), output_mode="update")
    updates = spark.read.parquet(path)
    assert updates.count() > 30
    newest = updates.groupBy("window_start").agg(F.max_by("n", "batch_id").alias("n"))
    assert (newest.count(), newest.agg(F.sum("n")).first()[0]) == (30, 1000)


def test_event_time_is_the_given_one_or_now(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert dict(windows.with_event_time(df, "t").dtypes)[windows.EVENT_TIME] == "timestamp"
    named = df.withColumnRenamed("t", windows.EVENT_TIME)
    assert windows.with_event_time(named).select(F.year(windows.EVENT_TIME)).first()[0] == 2024
    assert windows.with_event_time(df).select(F.year(windows.EVENT_TIME)).first()[0] >= 2024


def test_stream_columns_need_no_job(spark, sf_dir):
    stream = runs.read_table_stream(spark, sf_dir, "customer")
    marked = batches.add_stream_columns(stream, CUSTOMER_V1)
    assert marked.isStreaming
    assert marked.columns[-3:] == ["_schema_valid", "_quality_check_time", "_processing_time"]
    fits = batches.add_stream_columns(views.customer_src(spark, sf_dir), CUSTOMER_V1).first()
    assert fits["_schema_valid"]
    assert not batches.add_stream_columns(spark.range(1), CUSTOMER_V1).first()["_schema_valid"]
    kept = batches.add_stream_columns(spark.range(1).withColumn("_processing_time", F.lit(1)))
    assert kept.first()["_processing_time"] == 1


def test_full_grading_of_micro_batches(spark, sf_dir, landed, tmp_path):
    source = {"name": "feed", "validation_rules": {"value": {"min": 1, "max": 100}}, "datetime_column": "ts", "classification_rules": {"timeliness": 60}}
    path = str(tmp_path / "full")
    run(event_stream(spark, landed), tmp_path, grade_and_write_batches(path, source, Run("r", dt.datetime(2024, 2, 1))))
    rows = spark.read.parquet(f"{path}/rows")
    assert rows.count() == 1000
    assert set(rows.columns) >= {"data_classification", "metric_completeness", "schema_valid", "batch_id"}
    counts = scoring.merge_counts(spark.read.parquet(f"{path}/counts")).first()
    spec = QualitySpec(rules=source["validation_rules"], date_column="ts", max_age_days=60)
    whole = scoring.count_cells(views.table(spark, sf_dir, "events"), spec, AS_OF).first()
    assert counts.asDict() == whole.asDict()


def test_events_reach_the_callback_and_broken_ones_do_not(spark, sf_dir, landed, tmp_path):
    seen = []
    feed = views.as_event_src(event_stream(spark, landed, 2))
    handler = batches.per_event("k int", lambda events, batch_id: seen.append((batch_id, events.count())), "payload")
    run(feed, tmp_path, handler)
    assert sorted(b for b, _ in seen) == [0, 1]
    assert sum(n for _, n in seen) == 980


def test_batch_stats_skip_empty_batches(spark, tmp_path):
    handler = batches.batch_stats(str(tmp_path / "s"))
    handler(spark.range(5), 0)
    handler(spark.range(0), 1)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [(5, 0)]


def test_sinks_are_checked(spark, sf_dir, tmp_path):
    stream = runs.read_table_stream(spark, sf_dir, "events", 1)
    for options, message in (({"sink": "fax"}, "unknown sink"), ({"output_mode": "replace"}, "unknown output mode"), ({}, "needs a handler")):
        with pytest.raises(ValueError, match=message):
            runs.start_sink(stream, "q", str(tmp_path), **options)


def test_memory_sink_and_timed_trigger(spark, sf_dir, tmp_path):
    query = runs.start_sink(
        runs.read_table_stream(spark, sf_dir, "events"), "memory_events", str(tmp_path), sink="memory", trigger="1 second"
    )
    query.processAllAvailable()
    assert runs.stream_status(spark, [query]).first()["is_active"]
    query.stop()
    assert spark.table("memory_events").count() == 1000


def test_only_enabled_streaming_sources_start(spark, sf_dir, tmp_path):
    sources = [
        {"name": "events", "streaming_enabled": True}, {"name": "orders"}, {"name": "customer", "streaming_enabled": True, "enabled": False},
    ]
    started = runs.start_streams(
        spark,
        sources,
        lambda stream, s: runs.start_sink(stream, name(), str(tmp_path), trigger=None, handler=batches.write_batches(str(tmp_path / s["name"]))),
        read=lambda spark, s: runs.read_table_stream(spark, sf_dir, s["name"]),
    )
    for query in started.values():
        runs.run_available(query)
    assert set(started) == {"events"}
    assert runs.run_summary(started)["streaming_sources"] == 1


def test_schema_files_become_events(spark, tmp_path):
    folder, registry, events = tmp_path / "schemas", str(tmp_path / "registry"), str(tmp_path / "events")
    query = name()

    def land(definition):
        path = folder / definition.name / f"v{definition.version}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(definition_to_json(definition))
        run(schema_changes.schema_file_stream(spark, str(folder)), tmp_path, schema_changes.record_schema_changes(registry, events), query)

    land(CUSTOMER_V1)
    land(CUSTOMER_V2)
    land(evolve_definition(CUSTOMER_V2, {"remove_fields": ["city"], "modify_fields": {"phone": {"type": "int"}}}, 3))
    assert spark.read.parquet(registry).count() == 3
    rows = {r["version"]: r for r in spark.read.parquet(events).collect()}
    assert rows[1]["old_definition"] is None
    assert json.loads(rows[2]["old_definition"])["version"] == 1
    changed = schema_changes.changed_fields(spark.read.parquet(events).where("version = 3")).collect()
    assert {(r["field"], r["change"]) for r in changed} == {("city", "remove"), ("phone", "modify")}


CONFIG = {
    "kafka_sources": [
        {"name": "events", "streaming_enabled": True, "event_schema": "k int", "value_column": "props"},
        {"name": "orders", "enabled": False},
    ]
}


def read_events(sf_dir):
    return lambda spark, source: runs.read_table_stream(spark, sf_dir, source["name"])


def test_configured_streams_are_graded_and_counted(spark, sf_dir, tmp_path):
    run_settings = Run("r", dt.datetime(2024, 2, 1))
    started = start_graded_streams(
        spark, CONFIG, run_settings, str(tmp_path / "out"), str(tmp_path / "c1"), trigger=None, read=read_events(sf_dir)
    )
    windowed = start_graded_streams(
        spark, CONFIG, run_settings, str(tmp_path / "out"), str(tmp_path / "c2"), trigger=None, window="1 day",
        read=lambda spark, s: windows.with_event_time(runs.read_table_stream(spark, sf_dir, s["name"]), "ts"),
    )
    for query in (*started.values(), *windowed.values()):
        runs.run_available(query)
    assert list(started) == list(windowed) == ["events"]
    rows = spark.read.parquet(str(tmp_path / "out" / "events" / "rows"))
    assert rows.count() == 1000
    assert rows.select("metric_timeliness").distinct().collect()[0][0] == 1.0
    assert spark.read.parquet(str(tmp_path / "out" / "events" / "windows")).agg(F.sum("n")).first()[0] == 937


def test_streams_of_messages_are_decoded_before_grading(spark, sf_dir, tmp_path):
    config = {"kafka_sources": [{"name": "events", "streaming_enabled": True, "value_schema": "k int", "value_column": "props"}]}
    started = start_graded_streams(
        spark, config, Run("r", dt.datetime(2024, 2, 1)), str(tmp_path / "out"), str(tmp_path / "c"), trigger=None, read=read_events(sf_dir)
    )
    runs.run_available(started["events"])
    rows = spark.read.parquet(str(tmp_path / "out" / "events" / "rows"))
    assert rows.where("k IS NOT NULL").count() == 1000
    assert rows.first()["data_classification"] == "gold"


def test_event_mode(spark, sf_dir, tmp_path):
    seen = []
    started = start_event_streams(
        spark, CONFIG, lambda events, _: seen.append(events.where("source_name = 'events'").agg(F.sum("k")).first()[0]),
        str(tmp_path), trigger=None, read=read_events(sf_dir),
    )
    assert list(started) == ["events"]
    runs.run_available(started["events"])
    expected = views.table(spark, sf_dir, "events").agg(F.sum(F.get_json_object("props", "$.k").cast("int"))).first()[0]
    assert sum(seen) == expected


@pytest.mark.parametrize("per_trigger", [None, 1, 3])
def test_tables_kept_as_a_file_or_as_a_folder_of_parts(spark, sf_dir, tmp_path, per_trigger):
    views.table(spark, sf_dir, "events").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    views.table(spark, sf_dir, "events").write.parquet(str(tmp_path / "events.parquet.old"))  # not this table
    for folder, name in ((str(tmp_path), "parts"), (sf_dir, "file")):
        stream = runs.read_table_stream(spark, folder, "events", per_trigger)
        out = str(tmp_path / f"out-{name}-{per_trigger}")
        runs.run_available(runs.start_sink(stream, f"{name}-{per_trigger}", str(tmp_path / "c"), trigger=None, handler=batches.write_batches(out)))
        rows = spark.read.parquet(out)
        assert rows.count() == 1000
        if per_trigger and name == "parts":
            assert rows.select("batch_id").distinct().count() == -(-5 // per_trigger)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        runs.read_table_stream(spark, str(tmp_path), "absent")


def test_schema_changes_do_not_depend_on_the_waves(spark, tmp_path):
    versions = [(n, '{"name": "s", "version": %d, "fields": [%s]}' % (n, ", ".join('{"name": "f%d", "type": "int", "nullable": true}' % k for k in range(n % 3, n)))) for n in range(1, 8)]
    found = []
    for size in (1, 3, 7):
        landed, known, events = (str(tmp_path / f"{label}{size}") for label in ("landed", "known", "events"))
        for start in range(0, 7, size):
            part = spark.createDataFrame(versions[start : start + size], "n int, value string").select("value")
            part.write.mode("append").text(landed)
            stream = schema_changes.schema_file_stream(spark, landed, "*.txt", one_per_file=False)
            runs.run_available(runs.start_sink(stream, f"waves{size}", str(tmp_path / "c"), trigger=None, handler=schema_changes.record_schema_changes(known, events)))
        found.append(sorted(tuple(r) for r in schema_changes.changed_fields(spark.read.parquet(events)).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) > 7
