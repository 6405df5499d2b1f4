from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayer.functions import text
from assayer.operators import documents, latest, monitor, runlog
from assayer.session import cut_lineage


def test_latest_per_key_breaks_ties_and_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), (None, 1, 1, "n")], "k string, t int, seq int, v string"
    )
    rows = {r["k"]: r["v"] for r in latest.latest_per_key(df, ["k"], ["t", "seq"]).collect()}
    assert rows == {"a": "z", None: "n"}


def test_latest_of_a_hot_key_equals_brute_force(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") * 7919 % 9001).alias("t"),
        F.col("id").alias("v"),
    )
    best = {}
    for k, t, v in df.collect():
        if k not in best or t > best[k][0]:
            best[k] = (t, v)
    found = {r["k"]: (r["t"], r["v"]) for r in latest.latest_per_key(df, ["k"], ["t"]).collect()}
    assert found == best


@pytest.mark.parametrize("slices", [None, 1, 4, 30])
def test_running_total_equals_brute_force(spark, slices):
    # A third of the rows share one moment, so the order must split them by sequence.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") * 31 % 101).alias("t"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 13).alias("n"),
    )
    expected, so_far = {}, 0
    for t, seq, n in sorted(df.collect(), key=lambda r: (r["t"], r["seq"])):
        so_far += n or 0
        expected[seq] = so_far
    found = latest.running_total(df, "n", ["t", "seq"], "total", slices).collect()
    assert {r["seq"]: r["total"] for r in found} == expected


def test_running_total_spreads_rows_over_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("t"), F.col("id").alias("seq"), F.lit(1).alias("n"))
    plan = latest.running_total(df, "n", ["t", "seq"], "total", 8)
    spread = plan.withColumn("p", F.floor((F.col("total") - 1) / 500)).groupBy("p").count().collect()
    assert len(spread) == 8
    assert plan.agg(F.max("total")).first()[0] == 4000


def test_running_total_of_nothing(spark):
    df = spark.createDataFrame([], "t int, n int")
    assert latest.running_total(df, "n", ["t"], "total").count() == 0


def test_cut_lineage_keeps_the_rows(spark):
    assert cut_lineage(spark.range(10)).count() == 10


def runs(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "seq int, source_name string, source_type string, status string, classification string, record_count bigint, finished_at timestamp_ntz",
    )


T0 = dt.datetime(2024, 1, 1)


def test_run_totals_skip_failed_sources_and_stream_records(spark):
    df = runs(
        spark,
        ("a", "file", "success", "gold", 10, T0),
        ("b", "kafka", "success", "gold", 99, T0 + dt.timedelta(seconds=90)),
        ("c", "file", "failed", "gold", 7, T0),
        ("d", "api", "success", "rejected", 5, T0),
    )
    row = monitor.run_totals(df).first().asDict()
    assert (row["sources_processed"], row["sources_failed"], row["records_processed"]) == (3, 1, 15)
    assert (row["gold_count"], row["silver_count"], row["rejected_count"], row["duration_seconds"]) == (10, 0, 5, 90.0)
    nothing = monitor.run_totals(df.where("false")).first()
    assert (nothing["sources_processed"], nothing["records_processed"]) == (0, 0)


def test_tier_distribution_always_has_four_tiers(spark):
    df = runs(spark, ("a", "file", "success", "gold", 10, T0))
    rows = {r["tier"]: r["records"] for r in monitor.tier_distribution(df).collect()}
    assert rows == {"gold": 10, "silver": 0, "bronze": 0, "rejected": 0}
    assert monitor.tier_distribution(df.where("false")).count() == 4


def test_percentage_is_cut_not_rounded(spark):
    df = spark.range(3).select((F.col("id") < 2).alias("ok"))
    assert monitor.validation_stats(df, F.col("ok")).first()["valid_percentage"] == 66
    assert monitor.validation_stats(df.where("false"), F.col("ok")).first()["valid_percentage"] == 0


def test_quiet_days_show_zero(spark):
    df = runs(spark, ("a", "file", "success", "gold", 10, T0), ("a", "file", "success", "gold", 1, T0 - dt.timedelta(days=9)))
    rows = {r["day"]: r["records"] for r in monitor.records_per_day(df, dt.date(2024, 1, 3)).collect()}
    assert len(rows) == 7
    assert rows[dt.date(2024, 1, 1)] == 10
    assert sum(rows.values()) == 10


def test_sources_count_once_and_pending_ones_appear(spark):
    df = runs(spark, ("a", "file", "failed", None, 1, T0), ("a", "file", "success", "gold", 2, T0), ("b", "api", "success", "gold", 3, T0))
    assert {r["source_type"]: r["n"] for r in monitor.sources_by_type(df).collect()} == {"file": 1, "api": 1}
    configured = spark.createDataFrame([("a", "file"), ("z", "nvd")], "source_name string, source_type string")
    rows = {r["source_name"]: r["status"] for r in monitor.with_pending(configured, monitor.latest_status(df)).collect()}
    assert rows == {"a": "success", "b": "success", "z": "pending"}
    assert [r["source_name"] for r in monitor.first_sources(df, 1).collect()] == ["a"]
    assert [r["seq"] for r in monitor.recent_activity(df, 2).collect()] == [2, 1]


def test_source_detail_keeps_sources_nothing_is_known_of(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b, c = spark.createDataFrame([(1, "s")], "k int, status string"), spark.createDataFrame([(2, True)], "k int, valid boolean")
    rows = monitor.source_detail(a, b, c, key="k").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "s", None), (2, None, True)]


def test_event_log_takes_untimed_events_as_new(spark):
    df = spark.createDataFrame([(1, T0, "a"), (2, None, "a"), (3, T0 + dt.timedelta(1), "b")], "event_id int, ts timestamp_ntz, event_type string")
    assert [r["event_id"] for r in monitor.recent_events(df, limit=2).collect()] == [2, 3]
    assert [r["event_id"] for r in monitor.recent_events(df, "b").collect()] == [3]


def test_updates_merge_and_only_timed_ones_enter_the_history(spark):
    df = spark.createDataFrame([(1, "r1", 5, None), (2, None, None, 7), (3, "r2", None, None)], "seq int, last_run string, a int, b int")
    row = monitor.merge_updates(df, ["seq"], "last_run").first()
    assert (row["last_run"], row["a"], row["b"], row["history_rows"]) == ("r2", 5, 7, 2)


BANDS = [(None, "N/A", "N/A"), (1.0, "good", "good"), (0.9, "good", "good"), (0.89, "medium", "medium"), (0.8, "medium", "medium"),
         (0.79, "borderline", "medium"), (0.7, "borderline", "medium"), (0.69, "poor", "poor")]


def test_bands(spark):
    df = spark.createDataFrame(BANDS, "s double, four string, three string")
    s = F.col("s")
    wrong = df.where((text.quality_band(s) != F.col("four")) | (text.gauge_band(s) != F.col("three")) | (text.match_band(s) != F.col("three")))
    assert wrong.count() == 0


@pytest.mark.parametrize(
    ("seconds", "expected"),
    [(0, "0 seconds ago"), (1, "1 seconds ago"), (59, "59 seconds ago"), (60, "1 minute ago"), (3599, "59 minutes ago"),
     (3600, "1 hour ago"), (7200, "2 hours ago"), (86399, "23 hours ago"), (86400, "1 day ago"), (200000, "2 days ago")],
)
def test_elapsed(spark, seconds, expected):
    df = spark.createDataFrame([(T0,)], "t timestamp_ntz")
    as_of = F.lit((T0 + dt.timedelta(seconds=seconds)).isoformat(sep=" ")).cast("timestamp_ntz")
    assert df.select(text.elapsed_text(F.col("t"), as_of).alias("e")).first()["e"] == expected


def test_messages(spark):
    def message(**columns):
        kind = columns.pop("kind")
        made = text.event_message(F.lit(kind), **{k: F.lit(v) for k, v in columns.items()})
        return spark.range(1).select(made.alias("m")).first()["m"]

    assert message(kind="metrics", records_processed=1234567, gold_count=1000) == "Processed 1,234,567 records (1,000 gold)"
    assert message(kind="metrics", records_processed=5, gold_count=0) == "Processed 5 records"
    assert message(kind="source_status", status="success", record_count=5) == "Source successfully processed 5 records"
    assert message(kind="source_status", status="failed", record_count=0) == "Source failed processing"
    assert message(kind="schema_event", schema_event="schema_evolved", schema_name="s", version="v2") == "Schema 's' evolved to version v2"
    assert message(kind="schema_event", schema_event="other", message="m") == "m"
    assert message(kind="other") == "Event received"


def test_names(spark):
    row = spark.range(1).select(
        text.table_name("data_", F.lit("gold"), F.lit("My-Feed")).alias("t"),
        text.document_index(F.lit("gold"), F.lit("My-Feed"), F.lit(T0.date())).alias("d"),
        text.daily_index("metrics", F.lit(T0.date())).alias("m"),
    ).first()
    assert tuple(row) == ("data_gold_my_feed", "gold_my-feed_2024-01-01", "metrics-2024.01.01")


def test_documents(spark):
    stored = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "c", 2)], "id int, v string, w int")
    rows = {r["id"]: (r["v"], r["result"]) for r in documents.upsert_documents(stored, "id", ["w"]).collect()}
    assert rows == {1: ("c", "updated"), 2: ("b", "created")}
    ids = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    docs = documents.upsert_documents(stored, "id", ["w"])
    assert [r["id"] for r in documents.delete_documents(docs, ids, "id").collect()] == [2]
    assert {r["id"]: r["result"] for r in documents.delete_results(docs, ids, "id").collect()} == {1: "deleted", 9: "not_found"}
    found = documents.search_documents(stored, F.col("w") == 1, [F.col("id")], size=1, from_=1).collect()
    assert [r["id"] for r in found] == [2]
    made = documents.document_rows(stored, F.lit("i")).first()
    assert (made["_id"], made["_source"]) == (None, '{"id":1,"v":"a","w":1}')


def test_run_log_reads_json_and_evaluates_nothing(spark):
    lines = [
        '2024-01-01 00:00:01,000 - m - INFO - Pipeline metrics: {"seq": 1, "records_processed": 5}',
        "2024-01-01 00:00:02,000 - m - INFO - Pipeline metrics: {'seq': 2}",
        '2024-01-01 00:00:03,000 - m - INFO - Source metrics: {"seq": 3, "source_name": "a", "source_type": "file", "record_count": 1}',
        '2024-01-01 00:00:04,000 - m - INFO - Source metrics: {"seq": 4, "source_name": "a", "source_type": "file", "record_count": 2}',
        '2024-01-01 00:00:05,000 - m - INFO - Source metrics: {"seq": 5, "record_count": 9}',
        "2024-01-01 00:00:06,000 - m - INFO - Source metrics: {'seq': __import__('os').getpid()}",
        "Source metrics: __import__('os')",
        "",
    ]
    parsed = runlog.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r["seq"]: r["records_processed"] for r in runlog.run_rows(parsed).collect()} == {1: 5, 2: 0}
    assert [(r["source_name"], r["record_count"]) for r in runlog.source_rows(parsed).collect()] == [("a", 2)]
    assert runlog.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), tail=1).first()["seq"] == 5
