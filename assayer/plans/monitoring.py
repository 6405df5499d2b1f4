"""Queries on runs, sources, events and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions import text
from assayer.operators import documents, latest, monitor, runlog, tiering
from assayer.plans import views
from assayer.plans.catalog import register
from assayer.plans.views import LAST_DAY, RUN_AT, SOURCE_RUNS, ntz
from assayer.session import fresh_path
from assayer.sinks import documents as document_sink

DONE = "status = 'success' AND source_type <> 'kafka'"


def _records_sql(tier: str | None = None) -> str:
    also = f" AND classification = '{tier}'" if tier else ""
    return f"CAST(sum(CASE WHEN {DONE}{also} THEN record_count ELSE 0 END) AS BIGINT) AS {tier + '_count' if tier else 'records_processed'}"


TOTALS_SQL = ", ".join(
    [
        "count(*) FILTER (WHERE status = 'success') AS sources_processed",
        "count(*) FILTER (WHERE status = 'failed') AS sources_failed",
        _records_sql(),
        *[_records_sql(t) for t in ("gold", "silver", "bronze", "rejected")],
        "min(finished_at) AS start_time, max(finished_at) AS end_time",
        "round((epoch_us(max(finished_at)) - epoch_us(min(finished_at))) / 1e6, 3) AS duration_seconds",
    ]
)


@register("run_totals", f"SELECT {TOTALS_SQL} FROM {SOURCE_RUNS}")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = monitor.run_totals(views.source_runs(spark, sf_dir))
    return totals.withColumn("duration_seconds", F.round("duration_seconds", 3))


@register("run_totals_by_day", f"SELECT CAST(finished_at AS DATE) AS day, {TOTALS_SQL} FROM {SOURCE_RUNS} GROUP BY 1")
def run_totals_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = views.source_runs(spark, sf_dir).withColumn("day", F.col("finished_at").cast("date"))
    return monitor.run_totals(runs, ["day"]).withColumn("duration_seconds", F.round("duration_seconds", 3))


@register(
    "tier_distribution",
    f"""SELECT t.tier, CAST(coalesce(sum(r.record_count), 0) AS BIGINT) AS records FROM (SELECT 'gold' AS tier UNION ALL SELECT 'silver'
 UNION ALL SELECT 'bronze' UNION ALL SELECT 'rejected') t LEFT JOIN {SOURCE_RUNS.replace(') source_runs', ') r')} ON r.classification = t.tier GROUP BY t.tier""",
)
def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.tier_distribution(views.source_runs(spark, sf_dir))


@register(
    "source_type_counts",
    f"SELECT source_type, count(*) AS n FROM (SELECT DISTINCT source_name, source_type FROM {SOURCE_RUNS}) q GROUP BY source_type",
)
def source_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.sources_by_type(views.source_runs(spark, sf_dir))


@register("source_status_counts", f"SELECT status, count(*) AS n FROM {SOURCE_RUNS} GROUP BY status")
def source_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.counts_by(views.source_runs(spark, sf_dir), "status")


@register(
    "validation_stats",
    f"""SELECT count(*) FILTER (WHERE status = 'success') AS valid_count, count(*) FILTER (WHERE status <> 'success') AS invalid_count,
 count(*) AS total_count, CAST(floor(count(*) FILTER (WHERE status = 'success') * 100.0e0 / count(*)) AS INT) AS valid_percentage
 FROM {SOURCE_RUNS}""",
)
def validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.validation_stats(views.source_runs(spark, sf_dir), F.col("status") == "success")


@register(
    "records_per_day",
    f"""SELECT d.day, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS records
 FROM (SELECT CAST(DATE '2024-01-24' + CAST(i AS INT) AS DATE) AS day FROM range(0, 7) r(i)) d
 LEFT JOIN {SOURCE_RUNS.replace(') source_runs', ') s')} ON CAST(s.finished_at AS DATE) = d.day GROUP BY d.day""",
)
def records_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.records_per_day(views.source_runs(spark, sf_dir), LAST_DAY)


@register(
    "latest_status",
    f"""SELECT source_name, source_type, status, classification, record_count, finished_at FROM
 (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY finished_at DESC, seq DESC) AS rn FROM {SOURCE_RUNS}) q WHERE rn = 1""",
)
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.latest_status(views.source_runs(spark, sf_dir)).drop("seq")


@register(
    "run_history",
    f"""SELECT seq, record_count, CAST(sum(record_count) OVER (ORDER BY finished_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
 AS BIGINT) AS cumulative_records FROM {SOURCE_RUNS}""",
)
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = views.source_runs(spark, sf_dir).select("seq", "record_count", "finished_at")
    history = latest.running_total(runs, "record_count", ["finished_at", "seq"], "cumulative_records")
    return history.drop("finished_at")


@register(
    "recent_events",
    "SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 100",
)
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.recent_events(views.table(spark, sf_dir, "events"), "error").select("event_id", "event_type")


@register(
    "recent_activity",
    f"SELECT source_name, status, record_count FROM {SOURCE_RUNS} ORDER BY finished_at DESC, seq DESC LIMIT 10",
)
def recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.recent_activity(views.source_runs(spark, sf_dir)).select("source_name", "status", "record_count")


@register("first_sources", f"SELECT source_name FROM {SOURCE_RUNS} GROUP BY source_name ORDER BY min(seq) LIMIT 5")
def first_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.first_sources(views.source_runs(spark, sf_dir))


@register(
    "pending_sources",
    """SELECT c.c_custkey AS source_id, 'pending' AS status FROM customer c
 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)""",
)
def pending_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"))
    results = views.table(spark, sf_dir, "orders").where("o_totalprice > 400000")
    return monitor.pending_sources(configured, results.select(F.col("o_custkey").alias("source_id")), "source_id")


@register(
    "source_detail",
    """SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS VARCHAR), 'N/A') AS quality, p.pages FROM documents d
 LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN (SELECT page_id AS doc_id, count(*) AS pages FROM pages GROUP BY page_id) p ON p.doc_id = d.doc_id""",
)
def source_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    pages = views.table(spark, sf_dir, "pages").groupBy(F.col("page_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("pages"))
    detail = monitor.source_detail(configured, views.table(spark, sf_dir, "labels"), pages, key="doc_id")
    quality = F.coalesce(F.col("quality").cast("string"), F.lit("N/A"))
    return detail.select("doc_id", "lang", quality.alias("quality"), "pages")


@register(
    "source_overview",
    f"""WITH c AS (SELECT c_custkey, 'src-' || CAST(c_custkey AS VARCHAR) AS source_name, 'file' AS source_type FROM customer),
 l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY finished_at DESC, seq DESC) AS rn FROM {SOURCE_RUNS}) q WHERE rn = 1)
 SELECT source_name, source_type, status, record_count FROM l
 UNION ALL SELECT source_name, source_type, 'pending', NULL FROM c WHERE source_name NOT IN (SELECT source_name FROM l)""",
)
def source_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("src-"), F.col("c_custkey").cast("string"))
    configured = views.table(spark, sf_dir, "customer").select(name.alias("source_name"), F.lit("file").alias("source_type"))
    overview = monitor.with_pending(configured, monitor.latest_status(views.source_runs(spark, sf_dir)))
    return overview.select("source_name", "source_type", "status", "record_count")


@register(
    "event_message",
    f"""SELECT seq, CASE
 WHEN seq % 4 = 0 THEN 'Processed ' || format('{{:,}}', record_count) || ' records'
   || CASE WHEN classification = 'gold' AND record_count > 0 THEN ' (' || format('{{:,}}', record_count) || ' gold)' ELSE '' END
 WHEN seq % 4 = 1 THEN CASE status WHEN 'success' THEN 'Source successfully processed' ELSE 'Source failed processing' END
   || CASE WHEN record_count <> 0 THEN ' ' || format('{{:,}}', record_count) || ' records' ELSE '' END
 WHEN seq % 4 = 2 THEN CASE status WHEN 'success' THEN 'Schema ''' || source_name || ''' updated'
   WHEN 'failed' THEN 'Schema ''' || source_name || ''' evolved to version v2' ELSE 'Evolution requested for schema ''' || source_name || '''' END
 ELSE CASE WHEN classification = 'rejected' THEN 'Event received' ELSE 'note ' || classification END END AS message FROM {SOURCE_RUNS}""",
)
def event_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("seq") % 4
    status, tier, count = F.col("status"), F.col("classification"), F.col("record_count")
    message = text.event_message(
        F.when(kind == 0, "metrics").when(kind == 1, "source_status").when(kind == 2, "schema_event").otherwise("note"),
        message=F.when(tier != "rejected", F.concat(F.lit("note "), tier)),
        records_processed=count,
        gold_count=F.when(tier == "gold", count),
        status=status,
        record_count=count,
        schema_event=F.when(status == "success", "schema_updated").when(status == "failed", "schema_evolved")
        .otherwise("evolution_requested"),
        schema_name=F.col("source_name"),
        version=F.lit("v2"),
    )
    return views.source_runs(spark, sf_dir).select("seq", message.alias("message"))


@register(
    "report_columns",
    """SELECT event_id, CASE WHEN sec < 60 THEN CAST(sec AS VARCHAR) || ' seconds ago'
 WHEN sec < 3600 THEN CAST(sec // 60 AS VARCHAR) || CASE WHEN sec // 60 = 1 THEN ' minute ago' ELSE ' minutes ago' END
 WHEN sec < 86400 THEN CAST(sec // 3600 AS VARCHAR) || CASE WHEN sec // 3600 = 1 THEN ' hour ago' ELSE ' hours ago' END
 ELSE CAST(sec // 86400 AS VARCHAR) || CASE WHEN sec // 86400 = 1 THEN ' day ago' ELSE ' days ago' END END AS elapsed
 FROM (SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 1e6) AS BIGINT) AS sec FROM events) q""",
)
def report_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return events.select("event_id", text.elapsed_text(F.col("ts"), ntz("2024-01-31 00:00:00")).alias("elapsed"))


@register(
    "quality_band",
    f"""SELECT seq, CASE WHEN score IS NULL THEN 'N/A' WHEN score >= 0.9 THEN 'good' WHEN score >= 0.8 THEN 'medium'
 WHEN score >= 0.7 THEN 'borderline' ELSE 'poor' END AS band
 FROM (SELECT seq, CASE WHEN status <> 'pending' THEN record_count / 3300.0e0 END AS score FROM {SOURCE_RUNS}) q""",
)
def quality_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("status") != "pending", F.col("record_count") / F.lit(3300.0))
    return views.source_runs(spark, sf_dir).select("seq", text.quality_band(score).alias("band"))


@register(
    "gauge_band",
    f"""SELECT seq, CASE WHEN record_count / 3300.0e0 >= 0.9 THEN 'good' WHEN record_count / 3300.0e0 >= 0.7 THEN 'medium'
 ELSE 'poor' END AS band FROM {SOURCE_RUNS}""",
)
def gauge_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("record_count") / F.lit(3300.0)
    return views.source_runs(spark, sf_dir).select("seq", text.gauge_band(score).alias("band"))


@register(
    "tier_names",
    f"""SELECT DISTINCT lower(replace('data_' || classification || '_' || source_name, '-', '_')) AS table_name,
 lower(classification || '_' || source_name || '_2024-02-01') AS index_name FROM {SOURCE_RUNS}""",
)
def tier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier, source = F.col("classification"), F.col("source_name")
    return (
        views.source_runs(spark, sf_dir)
        .select(
            text.table_name("data_", tier, source).alias("table_name"),
            text.document_index(tier, source, F.lit(views.AS_OF)).alias("index_name"),
        )
        .distinct()
    )


@register(
    "date_parts",
    "SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day FROM events",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiering.add_date_parts(views.table(spark, sf_dir, "events"), F.col("ts")).select("event_id", "year", "month", "day")


@register(
    "stamp_events",
    "SELECT event_id, 'user_events' AS source_name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM events",
)
def stamp_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tiering.stamp_events(views.table(spark, sf_dir, "events"), "user_events", F.col("ts"))
    return events.select("event_id", "source_name", "timestamp")


@register(
    "ingest_columns",
    f"SELECT seq, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, classification AS classification_level FROM {SOURCE_RUNS}",
)
def ingest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = views.source_runs(spark, sf_dir)
    return tiering.add_ingest_columns(runs, F.col("classification"), RUN_AT).select(
        "seq", "ingestion_timestamp", "classification_level"
    )


@register(
    "daily_metrics_index",
    f"""SELECT 'metrics-' || replace(CAST(CAST(finished_at AS DATE) AS VARCHAR), '-', '.') AS index_name, count(*) AS n,
 CAST(sum(record_count) AS BIGINT) AS records FROM {SOURCE_RUNS} GROUP BY 1""",
)
def daily_metrics_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "metrics")
    metrics = views.source_runs(spark, sf_dir).select("source_name", "record_count", "finished_at")
    document_sink.write_metrics(documents.stamp_metrics(metrics, F.col("finished_at")), path)
    written = spark.read.schema("source_name string, record_count bigint, _index string").json(path)
    return written.groupBy(F.col("_index").alias("index_name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("record_count").alias("records")
    )


@register(
    "document_rows",
    """SELECT lower('silver_' || source || '_2024-02-01') AS _index, CAST(doc_id AS VARCHAR) AS _id,
 CAST(to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'text': text}) AS VARCHAR) AS _source FROM documents""",
)
def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = text.document_index(F.lit("silver"), F.col("source"), F.lit(views.AS_OF))
    rows = views.table(spark, sf_dir, "documents")
    return documents.document_rows(rows, index, "doc_id", ["doc_id", "lang", "n_chars", "text"])


@register(
    "document_store",
    """SELECT lower('silver_' || source || '_2024-02-01') AS index_name, CAST(doc_id AS VARCHAR) AS doc_id, n_chars,
 (SELECT count(*) FROM documents) AS written, 0::BIGINT AS errors FROM documents""",
)
def document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "documents")
    written, errors = document_sink.write_documents(_documents(spark, sf_dir), path)
    stored = spark.read.text(path).select("_index", F.from_json("value", "_id string, _source string").alias("d"))
    return stored.select(
        F.col("_index").alias("index_name"),
        F.col("d._id").alias("doc_id"),
        F.get_json_object("d._source", "$.n_chars").cast("bigint").alias("n_chars"),
        F.lit(written).cast("bigint").alias("written"),
        F.lit(errors).cast("bigint").alias("errors"),
    )


@register(
    "document_upsert",
    """SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars,
 CASE WHEN doc_id % 2 = 0 THEN 'updated' ELSE 'created' END AS result FROM documents""",
)
def document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    later = stored.where("doc_id % 2 = 0").withColumn("n_chars", F.col("n_chars") + 1)
    writes = stored.withColumn("write", F.lit(1)).unionByName(later.withColumn("write", F.lit(2)))
    return documents.upsert_documents(writes, "doc_id", ["write"]).drop("write")


@register(
    "document_delete",
    "SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)",
)
def document_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = views.table(spark, sf_dir, "labels").where("toxic = 1")
    return documents.delete_documents(views.table(spark, sf_dir, "documents"), toxic, "doc_id").select("doc_id", "lang")


@register(
    "document_delete_results",
    """SELECT o.o_custkey AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'not_found' ELSE 'deleted' END AS result
 FROM (SELECT DISTINCT o_custkey FROM orders) o LEFT JOIN documents d ON d.doc_id = o.o_custkey""",
)
def document_delete_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"))
    return documents.delete_results(views.table(spark, sf_dir, "documents"), wanted, "doc_id")


@register(
    "document_search",
    "SELECT doc_id, n_chars FROM documents WHERE lang = 'en' ORDER BY n_chars DESC, doc_id LIMIT 10 OFFSET 5",
)
def document_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    order = [F.desc("n_chars"), F.col("doc_id")]
    return documents.search_documents(docs, F.col("lang") == "en", order, 10, 5).select("doc_id", "n_chars")


@register(
    "kafka_rows",
    """SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value,
 '_timestamp': epoch_us(ts) // 1000}) AS VARCHAR) AS value, 'feed-' || event_type AS origin FROM events""",
)
def kafka_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id", "ts")
    rows = document_sink.to_kafka_rows(
        events,
        "events",
        key=F.col("user_id"),
        headers={"origin": F.concat(F.lit("feed-"), F.col("event_type"))},
        moment=F.col("ts"),
        fields=["event_id", "event_type", "value"],
    )
    return rows.select("topic", "key", "value", F.decode(F.col("headers")[0]["value"], "UTF-8").alias("origin"))


LINE_PAYLOAD = {
    "pipeline": ["seq", "record_count"],
    "source": ["seq", "source_name", "source_type", "status", "classification", "record_count"],
}


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of every run result: every fourth is a run's totals, some are noise or broken."""
    seq = F.col("seq")
    run = F.to_json(
        F.struct(
            "seq",
            F.col("record_count").alias("records_processed"),
            F.lit(1).alias("sources_processed"),
            F.when(F.col("classification") == "gold", F.col("record_count")).otherwise(0).alias("gold_count"),
        )
    )
    result = F.to_json(F.struct(*LINE_PAYLOAD["source"]))
    broken = F.lit("{'seq': __import__('os')}")
    stamp = F.concat(F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - metrics - INFO - "))
    line = (
        F.when(seq % 9 == 5, F.concat(stamp, F.lit("Reading source")))
        .when(seq % 9 == 7, F.concat(stamp, F.lit(runlog.SOURCE_MARKER + " "), broken))
        .when(seq % 4 == 0, F.concat(stamp, F.lit(runlog.RUN_MARKER + " "), run))
        .otherwise(F.concat(stamp, F.lit(runlog.SOURCE_MARKER + " "), result))
    )
    return views.source_runs(spark, sf_dir).select(line.alias("value"))


def landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "run-log")
    log_lines(spark, sf_dir).write.text(path)
    return spark.read.text(path)


@register(
    "parse_run_log",
    f"""SELECT seq, record_count AS records_processed, CASE WHEN classification = 'gold' THEN record_count ELSE 0 END AS gold_count
 FROM {SOURCE_RUNS} WHERE seq % 9 NOT IN (5, 7) AND seq % 4 = 0""",
)
def parse_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = runlog.run_rows(runlog.parse_lines(landed_log(spark, sf_dir)))
    return runs.select("seq", "records_processed", "gold_count")


@register(
    "parse_run_log_tail",
    f"""SELECT seq, record_count AS records_processed FROM (SELECT * FROM {SOURCE_RUNS} WHERE seq % 9 NOT IN (5, 7)
 ORDER BY date_trunc('millisecond', finished_at) DESC, seq DESC LIMIT 1000) q WHERE seq % 4 = 0""",
)
def parse_run_log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that looks at the newest 1000 entries only."""
    return runlog.run_rows(runlog.parse_lines(landed_log(spark, sf_dir), tail=1000)).select("seq", "records_processed")


@register(
    "parse_source_log",
    f"""SELECT source_name, status, classification, record_count FROM (SELECT *, row_number() OVER (PARTITION BY source_name
 ORDER BY date_trunc('millisecond', finished_at) DESC, seq DESC) AS rn FROM {SOURCE_RUNS} WHERE seq % 9 NOT IN (5, 7) AND seq % 4 <> 0) q WHERE rn = 1""",
)
def parse_source_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runlog.source_rows(runlog.parse_lines(landed_log(spark, sf_dir)))
    return rows.select("source_name", "status", "classification", "record_count")


@register(
    "merge_metrics",
    f"""SELECT arg_max(record_count, seq) FILTER (WHERE status = 'success') AS records_processed,
 arg_max(classification, seq) FILTER (WHERE status <> 'pending') AS classification, count(*) FILTER (WHERE status <> 'pending') AS history_rows
 FROM {SOURCE_RUNS}""",
)
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = views.source_runs(spark, sf_dir)
    updates = runs.select(
        "seq",
        F.when(F.col("status") != "pending", F.col("finished_at")).alias("last_run"),
        F.when(F.col("status") == "success", F.col("record_count")).alias("records_processed"),
        F.when(F.col("status") != "pending", F.col("classification")).alias("classification"),
    )
    merged = monitor.merge_updates(updates, ["seq"], history="last_run")
    return merged.select("records_processed", "classification", "history_rows")

