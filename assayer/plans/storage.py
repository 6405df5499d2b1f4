"""Queries that write graded data and read it back."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.checks import issue_rows, validate
from assayer.operators.monitor import run_totals
from assayer.operators.runlog import parse_lines, read_run_log
from assayer.operators.scoring import TIER_THRESHOLDS
from assayer.operators.tiering import add_ingest_columns
from assayer.plans import views
from assayer.plans.batch import Run, grade_source, process_all, process_one
from assayer.plans.catalog import register
from assayer.plans.definitions import CUSTOMER_ID, CUSTOMER_V1, EMAIL, PHONE, SALES_V1
from assayer.plans.scores import (
    SALES_ACCURACY,
    SALES_COMPLETENESS,
    SALES_SOURCE,
    TIER_SQL,
    quality_sql,
)
from assayer.plans.views import CUSTOMER_SRC, RUN_AT, SALES_SRC, SOURCE_RUNS
from assayer.session import fresh_path
from assayer.sinks.document_store import merge_documents, read_store, vacuum
from assayer.sinks.published import published, regrade, retire
from assayer.sinks.tiers import write_rejected, write_tier_files, write_tier_table, write_with_fallback
from assayer.sinks.documents import read_documents
from assayer.sources import ledger
from assayer.sources.catalog import describe_tables, read_table

SCHEMAS = {("sales_transactions", 1): SALES_V1, ("customer_data", 1): CUSTOMER_V1}


def tier_folders(spark: SparkSession) -> dict[str, str]:
    base = fresh_path(spark, "tiers")
    return {tier: f"{base}/{tier}" for tier in ("gold", "silver", "bronze", "rejected")}


@register(
    "process_source",
    quality_sql(
        """sales.*, g.tier AS data_classification, round(g.c, 6) AS metric_completeness, round(g.a, 6) AS metric_accuracy,
 g.t AS metric_timeliness, g.valid AS schema_valid, CAST(CASE WHEN g.valid THEN 0 ELSE 1 END AS INT) AS schema_error_count,
 CAST(CASE WHEN g.r < 0.9 THEN 1 ELSE 0 END AS INT) AS schema_warning_count,
 TIMESTAMP '2024-02-01 00:00:00' AS processing_timestamp, 'sales_transactions' AS source_name"""
    ),
)
def process_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run("run-1", RUN_AT, schemas=SCHEMAS)
    graded, _ = grade_source(views.sales_src(spark, sf_dir), SALES_SOURCE, run)
    return graded.withColumns(
        {c: F.round(c, 6) for c in ("metric_completeness", "metric_accuracy")}
    )


@register(
    "process_all",
    f"""WITH s AS (SELECT count(*) AS n, {SALES_COMPLETENESS} AS c, {SALES_ACCURACY} AS a, 0.5e0 AS t,
      min(quantity) >= 1 AND max(quantity) <= 10000 AS valid FROM {SALES_SRC}),
 e AS (SELECT count(*) AS n, 1.0e0 AS c, 1.0e0 - count(*) FILTER (WHERE NOT (value BETWEEN 1 AND 100)) / (count(*) * 6.0e0) AS a,
      greatest(0.0e0, least(1.0e0, 1.0e0 - avg(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01')) / 60)) AS t, true AS valid FROM events)
 SELECT source_name, source_type, status, classification, record_count, round(completeness, 6) AS completeness, round(accuracy, 6) AS accuracy,
  round(timeliness, 6) AS timeliness, schema_valid FROM (
 SELECT 'sales_transactions' AS source_name, 'file' AS source_type, 'success' AS status,
  CASE WHEN valid THEN {TIER_SQL} WHEN c >= 0.7 AND a >= 0.6 AND t >= 0.5 THEN 'bronze' ELSE 'rejected' END AS classification,
  n AS record_count, c AS completeness, a AS accuracy, t AS timeliness, valid AS schema_valid FROM s
 UNION ALL SELECT 'user_events', 'file', 'success', {TIER_SQL}, n, c, a, t, valid FROM e
 UNION ALL SELECT 'no_such_file', 'file', 'failed', NULL, 0, NULL, NULL, NULL, NULL
 UNION ALL SELECT 'no_such_topic', 'kafka', 'failed', NULL, 0, NULL, NULL, NULL, NULL) q""",
)
def process_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_all(spark, sf_dir).select(
        "source_name",
        "source_type",
        "status",
        "classification",
        "record_count",
        *[F.round(m, 6).alias(m) for m in ("completeness", "accuracy", "timeliness")],
        "schema_valid",
    )


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fresh_path(spark, "landed-sales")
    views.sales_src(spark, sf_dir).write.parquet(landed)
    config = {
        "file_sources": [
            {**SALES_SOURCE, "type": "parquet", "path": landed},
            {
                "name": "user_events",
                "type": "parquet",
                "path": f"{sf_dir}/events.parquet",
                "validation_rules": {"value": {"min": 1, "max": 100}},
                "datetime_column": "ts",
                "classification_rules": {"timeliness": 60},
            },
            {"name": "no_such_file", "type": "parquet", "path": f"{landed}-absent"},
            {"name": "switched_off", "type": "parquet", "path": landed, "enabled": False},
        ],
        "kafka_sources": [{"name": "no_such_topic"}],
    }
    return process_all(spark, config, Run("run-1", RUN_AT, tier_folders(spark), TIER_THRESHOLDS, SCHEMAS))


@register(
    "process_all_totals",
    """SELECT 2::BIGINT AS sources_processed, 2::BIGINT AS sources_failed,
 (SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey) + (SELECT count(*) FROM events)
 AS records_processed""",
)
def process_all_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(_run_all(spark, sf_dir)).select("sources_processed", "sources_failed", "records_processed")


@register(
    "tier_roundtrip",
    f"""SELECT seq, source_name, record_count, classification AS classification_level, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp,
 DATE '2024-02-01' AS ingestion_date, 'nightly' AS ingestion_run FROM {SOURCE_RUNS}""",
)
def tier_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = tier_folders(spark)
    runs = views.source_runs(spark, sf_dir)
    columns = ["seq", "source_name", "record_count"]
    frames = []
    for tier in folders:
        graded = runs.where(F.col("classification") == tier).select(*columns)
        path = write_tier_files(graded, tier, "source-runs", folders, RUN_AT, "nightly")
        write_tier_files(graded, tier, "source-runs", folders, RUN_AT, "nightly")  # a repeated run replaces itself
        frames.append(spark.read.parquet(path))
    written = frames[0]
    for frame in frames[1:]:
        written = written.unionByName(frame)
    return written


@register(
    "tier_table_roundtrip",
    f"""SELECT transaction_id, quantity, total_price, 'bronze' AS classification_level, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp,
 2024 AS year, 2 AS month, 1 AS day FROM {SALES_SRC}""",
)
def tier_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = f"Sales-{uuid.uuid4().hex}"
    graded = add_ingest_columns(
        views.sales_src(spark, sf_dir).select("transaction_id", "quantity", "total_price"), "bronze", RUN_AT
    )
    name = write_tier_table(graded, "bronze", source, RUN_AT.date(), path=fresh_path(spark, "table"))
    return read_table(spark, name)


@register("rejected_rows", f"SELECT seq, source_name FROM {SOURCE_RUNS} WHERE classification = 'rejected'")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = views.source_runs(spark, sf_dir).where("classification = 'rejected'")
    path = write_tier_files(rejected, "rejected", "source-runs", tier_folders(spark), RUN_AT)
    return spark.read.parquet(path).select("seq", "source_name")


@register(
    "rejected_issues",
    f"""WITH c AS (SELECT * FROM {CUSTOMER_SRC}), p AS (
 SELECT 'email' AS column_name, count(CASE WHEN regexp_matches(email, '{EMAIL}') THEN 1 END) / (count(*) * 1.0e0) AS r FROM c
 UNION ALL SELECT 'phone', count(CASE WHEN regexp_matches(phone, '{PHONE}') THEN 1 END) / (count(*) * 1.0e0) FROM c
 UNION ALL SELECT 'customer_id', count(CASE WHEN regexp_matches(customer_id, '{CUSTOMER_ID}') THEN 1 END) / (count(*) * 1.0e0) FROM c)
 SELECT 'customer_data' AS source_name, 'run-1' AS run_id, column_name, severity, (SELECT count(*) FROM c) AS rejected_rows FROM (
 SELECT column_name, 'warning' AS severity FROM p WHERE r < 0.9 UNION ALL SELECT column_name, 'error' FROM p WHERE r < 0.5
 UNION ALL SELECT 'acctbal', 'warning') q""",
)
def rejected_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = views.customer_src(spark, sf_dir)
    issues = issue_rows(validate(feed, CUSTOMER_V1))
    path, issues_path = write_rejected(feed, issues, "customer_data", "run-1", tier_folders(spark), RUN_AT)
    rows = spark.read.parquet(path).count()
    return spark.read.parquet(issues_path).select(
        "source_name", "run_id", "column_name", "severity", F.lit(rows).cast("bigint").alias("rejected_rows")
    )



@register(
    "tier_fallback",
    f"SELECT seq, 'files' AS written_as, 'silver' AS classification_level FROM {SOURCE_RUNS}",
)
def tier_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table store is not there, so the data goes to files."""
    runs = views.source_runs(spark, sf_dir).select("seq")
    database = f"absent_{uuid.uuid4().hex}"
    kind, where = write_with_fallback(runs, "silver", "source-runs", tier_folders(spark), RUN_AT, database=database)
    return spark.read.parquet(where).select("seq", F.lit(kind).alias("written_as"), "classification_level")


FEEDS = 14


@register(
    "runs_of_a_day",
    f"""SELECT 'feed-' || CAST(event_id % {FEEDS} AS VARCHAR) AS source_name, 2 * count(*) AS stored, count(*) AS documents, 2::BIGINT AS runs FROM events GROUP BY 1""",
)
def runs_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sources side by side, twice on one day: all rows, all documents and all reports are there."""
    folders, landing, documents, monitor = tier_folders(spark), fresh_path(spark, "feeds"), fresh_path(spark, "documents"), fresh_path(spark, "monitor")
    feeds = views.table(spark, sf_dir, "events").withColumn("feed", (F.col("event_id") % FEEDS).cast("int"))
    feeds.write.partitionBy("feed").parquet(landing)
    config = {"file_sources": [{"name": f"feed-{i}", "type": "parquet", "path": f"{landing}/feed={i}"} for i in range(FEEDS)]}
    for run_id in ("morning", "evening", "evening"):  # a repeated run replaces itself
        process_all(spark, config, Run(run_id, RUN_AT, folders, monitor_path=monitor, documents_path=documents))
    stored = None
    for folder in folders.values():
        for i in range(FEEDS):
            try:
                rows = spark.read.parquet(f"{folder}/feed-{i}").groupBy("source_name").agg(F.count(F.lit(1)).alias("stored"))
            except AnalysisException:  # this feed is in another tier
                continue
            stored = rows if stored is None else stored.unionByName(rows)
    kept = read_documents(spark, documents).select(F.get_json_object("_source", "$.source_name").alias("source_name"))
    kept = kept.groupBy("source_name").agg((F.count(F.lit(1)) / 2).cast("bigint").alias("documents"))
    runs = spark.read.parquet(f"{monitor}/source_runs").where("status = 'success'").groupBy("source_name").agg(F.count_distinct("run_id").alias("runs"))
    return stored.join(kept, "source_name", "left").join(runs, "source_name", "left")


@register(
    "incremental_runs",
    "SELECT event_id, event_type FROM events",
)
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs, the second with rows of the mark's own moment and rows without a time, load every row once."""
    folders, landing, state = tier_folders(spark), fresh_path(spark, "events"), fresh_path(spark, "state")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    events = views.table(spark, sf_dir, "events").withColumn("changed", F.when(F.col("event_id") % 7 != 0, day))
    source = {"name": "changes", "type": "parquet", "path": landing, "incremental": {"column": "changed", "keys": ["event_id"]}}
    mark, even = F.lit("2024-01-15").cast("timestamp_ntz"), F.col("event_id") % 2 == 0
    early = F.coalesce((F.col("changed") < mark) | ((F.col("changed") == mark) & even), even)
    for run_id, part in (("first", events.where(early)), ("second", events.where(~early)), ("third", events.limit(0))):
        part.write.mode("append").parquet(landing)
        process_all(spark, {"file_sources": [source]}, Run(run_id, RUN_AT, folders, state_path=state))
    found = None
    for folder in folders.values():
        try:
            rows = spark.read.parquet(f"{folder}/changes").select("event_id", "event_type")
        except AnalysisException:
            continue
        found = rows if found is None else found.unionByName(rows)
    return found


@register(
    "incremental_ledger",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('day', ts) END AS changed FROM events)
 SELECT event_id, CAST(changed AS TIMESTAMP) AS changed FROM e WHERE changed IS NULL OR changed = (SELECT max(changed) FROM e)""",
)
def incremental_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a source's ledger holds after four loads: the rows without a time and those of the mark's moment, once each."""
    folders, landing, state = tier_folders(spark), fresh_path(spark, "events"), fresh_path(spark, "state")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    events = views.table(spark, sf_dir, "events").withColumn("changed", F.when(F.col("event_id") % 7 != 0, day))
    source = {"name": "changes", "type": "parquet", "path": landing, "incremental": {"column": "changed", "keys": ["event_id"]}}
    kind, last = F.pmod("event_id", F.lit(3)), events.agg(F.max("changed")).first()[0]
    early = F.coalesce(F.col("changed") < F.lit(last), F.lit(False))
    waves = (early, ~early & (kind == 0), ~early & (kind == 1), ~early & (kind == 2))  # rows of the last day arrive in three loads
    for number, wave in enumerate(waves):
        events.where(wave).write.mode("append").parquet(landing)
        process_all(spark, {"file_sources": [source]}, Run(f"load-{number}", RUN_AT, folders, state_path=state))
    held = spark.read.schema(ledger.ENTRY).parquet(*ledger.load_ledger(spark, state, "changes").parts)
    held = held.where(F.col("moment").isNull() | (F.col("moment") == F.lit(last)))
    return held.select(F.get_json_object("entry", "$.event_id").cast("bigint").alias("event_id"), F.col("moment").alias("changed"))


@register(
    "run_log_of_runs",
    """SELECT run, 'source' AS kind, source_name, status, records, 0::BIGINT AS failed FROM (VALUES ('first'), ('second')) r(run),
 (SELECT 'user_events' AS source_name, 'success' AS status, (SELECT count(*) FROM events) AS records UNION ALL SELECT 'no_such_file', 'failed', 0) q
 UNION ALL SELECT run, 'pipeline', NULL, NULL, (SELECT count(*) FROM events), 1 FROM (VALUES ('first'), ('second')) r(run)""",
)
def run_log_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that three runs wrote, one of them a repeated one, read back."""
    monitor = fresh_path(spark, "monitor")
    config = {"file_sources": [
        {"name": "user_events", "type": "parquet", "path": f"{sf_dir}/events.parquet"},
        {"name": "no_such_file", "type": "parquet", "path": f"{monitor}-absent"},
    ]}
    for run_id in ("first", "second", "second"):
        process_all(spark, config, Run(run_id, RUN_AT, monitor_path=monitor))
    logged = parse_lines(read_run_log(spark, f"{monitor}/run_log"))
    told = F.from_json("payload", "run_id string, source_name string, status string, record_count bigint, records_processed bigint, sources_failed bigint")
    return logged.select("kind", told.alias("p")).select(
        F.col("p.run_id").alias("run"), "kind", "p.source_name", "p.status", F.coalesce("p.record_count", "p.records_processed").alias("records"),
        F.coalesce("p.sources_failed", F.lit(0)).cast("bigint").alias("failed"),
    )


@register("process_one", "SELECT 'user_events' AS source_name, 'file' AS source_type, 'success' AS status, count(*) AS record_count FROM events")
def process_one_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [{"name": n, "type": "parquet", "path": f"{sf_dir}/{n.removeprefix('user_')}.parquet"} for n in ("orders", "user_events")]
    done = process_one(spark, {"file_sources": sources}, "user_events", Run("run-1", RUN_AT, tier_folders(spark)))
    return done.select("source_name", "source_type", "status", "record_count")


@register(
    "catalog_columns",
    """SELECT name, type, is_partition, (SELECT count(*) FROM events) AS row_count FROM (VALUES ('event_id', 'bigint', false), ('event_type', 'string', false),
 ('ingestion_timestamp', 'timestamp_ntz', false), ('classification_level', 'string', false), ('year', 'int', true), ('month', 'int', true), ('day', 'int', true)) t(name, type, is_partition)""",
)
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = add_ingest_columns(views.table(spark, sf_dir, "events").select("event_id", "event_type"), "gold", RUN_AT)
    name = write_tier_table(graded, "gold", f"described-{uuid.uuid4().hex}", RUN_AT.date(), path=fresh_path(spark, "table"))
    columns = describe_tables(spark).where(F.col("table_name") == name)
    rows = spark.read.table(name).agg(F.count(F.lit(1)).alias("row_count"))
    return columns.select(F.col("column_name").alias("name"), "type", "is_partition", F.lit(rows.first()[0]).cast("bigint").alias("row_count"))


@register(
    "published_runs",
    f"""SELECT 'feed-' || CAST(event_id % {FEEDS} AS VARCHAR) AS source_name, 'archived' AS data_classification, 'morning' AS run_id, count(*) AS rows,
 count(value) AS held FROM events WHERE event_id % {FEEDS} < 3 GROUP BY 1
 UNION ALL SELECT 'feed-' || CAST(event_id % {FEEDS} AS VARCHAR), 'silver', 'evening',
 count(*), count(value) FROM (SELECT event_id, CASE WHEN event_id % 4 > 1 THEN value END AS value FROM events) q WHERE event_id % {FEEDS} < 3 GROUP BY 1""",
)
def published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs published by manifest: one repeated with other data and grade, one given another tier by hand; each shows one copy."""
    store, landing = fresh_path(spark, "published"), fresh_path(spark, "feeds")
    events = views.table(spark, sf_dir, "events").withColumn("feed", (F.col("event_id") % FEEDS).cast("int")).where("feed < 3")
    events.write.partitionBy("feed").parquet(f"{landing}/full")
    events.withColumn("value", F.when(F.col("event_id") % 4 > 1, F.col("value"))).write.partitionBy("feed").parquet(f"{landing}/half")

    def publish(run_id: str, part: str) -> None:
        sources = [{"name": f"feed-{i}", "type": "parquet", "path": f"{landing}/{part}/feed={i}", "datetime_column": "ts", "classification_rules": {"timeliness": 100000}} for i in range(3)]
        process_all(spark, {"file_sources": sources}, Run(run_id, RUN_AT, store_path=store))

    for run_id, part in (("morning", "full"), ("evening", "full"), ("evening", "half")):
        publish(run_id, part)
    found = None
    for i in range(3):
        regrade(spark, store, f"feed-{i}", "morning", "archived")
        retire(spark, store, f"feed-{i}")
        rows = published(spark, store, f"feed-{i}").groupBy("source_name", "data_classification", "run_id").agg(F.count("*").alias("rows"), F.count("value").alias("held"))
        found = rows if found is None else found.unionByName(rows)
    return found


@register(
    "document_store_runs",
    """SELECT CAST(event_id AS VARCHAR) AS _id, 'run ' || CASE WHEN event_id % 5 IN (2, 3) THEN '2' ELSE '1' END || ': ' || event_type AS _source,
 (SELECT count(*) FROM events WHERE event_id % 5 = 2) AS updated, (SELECT count(*) FROM events WHERE event_id % 7 = 0 AND event_id % 5 < 4) AS deleted,
 (SELECT count(*) FROM events WHERE event_id % 7 = 0 AND event_id % 5 = 4) AS not_found
 FROM events WHERE event_id % 5 < 4 AND event_id % 7 <> 0""",
)
def document_store_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store after three merges: documents created, some of them written again, and some deleted."""
    store, events = fresh_path(spark, "store"), views.table(spark, sf_dir, "events")

    def documents(rows: DataFrame, run: int | None) -> DataFrame:
        body = F.concat(F.lit(f"run {run}: "), "event_type") if run else F.lit(None).cast("string")
        return rows.select(F.lit("events").alias("_index"), F.col("event_id").cast("string").alias("_id"), body.alias("_source"))

    kind = F.col("event_id") % 5
    merge_documents(spark, store, documents(events.where(kind < 3), 1), buckets=16)
    second = merge_documents(spark, store, documents(events.where(kind.isin(2, 3)), 2))
    third = merge_documents(spark, store, documents(events.where(F.col("event_id") % 7 == 0), None))
    vacuum(spark, store)
    counts = {"updated": second["updated"], "deleted": third["deleted"], "not_found": third["not_found"]}
    return read_store(spark, store).select("_id", "_source", *(F.lit(n).cast("bigint").alias(c) for c, n in counts.items()))
