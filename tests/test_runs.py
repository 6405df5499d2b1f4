from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayer.operators.checks import issue_rows, validate
from assayer.operators.documents import document_rows, stamp_metrics
from assayer.plans import views
from assayer.plans.batch import Run, grade_source, process_all, process_one, process_source, profile_source, read_source
from assayer.plans.definitions import CUSTOMER_V1, CUSTOMER_V2, SALES_V1
from assayer.sinks import documents as document_sink
from assayer.sinks import tiers

RUN_AT = dt.datetime(2024, 2, 1, 6)
SCHEMAS = {("customer_data", 1): CUSTOMER_V1, ("customer_data", 2): CUSTOMER_V2, ("sales_transactions", 1): SALES_V1}


def folders(path):
    return {t: f"{path}/{t}" for t in ("gold", "silver", "bronze", "rejected")}


def test_unknown_tier_has_no_path(tmp_path):
    with pytest.raises(ValueError, match="no target path"):
        tiers.tier_path(folders(tmp_path), "platinum", "s")


def test_rerun_replaces_its_own_day_only(spark, tmp_path):
    paths = folders(tmp_path)
    tiers.write_tier_files(spark.range(3), "gold", "s", paths, RUN_AT - dt.timedelta(days=1))
    tiers.write_tier_files(spark.range(5), "gold", "s", paths, RUN_AT)
    path = tiers.write_tier_files(spark.range(4), "gold", "s", paths, RUN_AT)
    counts = {r["ingestion_date"]: r["count"] for r in spark.read.parquet(path).groupBy("ingestion_date").count().collect()}
    assert counts == {dt.date(2024, 1, 31): 3, dt.date(2024, 2, 1): 4}


def test_an_empty_rerun_replaces_its_day_too(spark, tmp_path):
    paths = folders(tmp_path)
    tiers.write_tier_files(spark.range(5), "gold", "s", paths, RUN_AT)
    assert spark.read.parquet(tiers.write_tier_files(spark.range(0), "gold", "s", paths, RUN_AT)).count() == 0


def test_changing_sources_are_read_once(spark, tmp_path, monkeypatch):
    from assayer.plans import batch

    reads = []
    monkeypatch.setattr(batch, "read_source", lambda spark, family, source: reads.append(family) or spark.range(5).withColumn("r", F.rand()))
    run = Run("r", RUN_AT, folders(tmp_path))
    assert process_source(spark, "database", {"name": "d"}, run)[6] == 5
    assert reads == ["database"]


def test_tier_table_name_and_parts(spark, tmp_path):
    name = tiers.write_tier_table(spark.range(2), "gold", "My-Test", RUN_AT.date(), path=str(tmp_path / "t"))
    assert name == "data_gold_my_test"
    tiers.write_tier_table(spark.range(3), "gold", "My-Test", RUN_AT.date(), path=str(tmp_path / "t"))
    df = spark.read.table(name)
    assert df.count() == 5
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name != "id"} == {"year": "int", "month": "int", "day": "int"}
    spark.sql(f"DROP TABLE {name}")


def test_fallback_to_files(spark, tmp_path):
    used, where = tiers.write_with_fallback(
        spark.range(2), "gold", "fb", folders(tmp_path), RUN_AT, database="no_such_database"
    )
    assert used == "files"
    assert spark.read.parquet(where).count() == 2
    used, name = tiers.write_with_fallback(spark.range(2), "gold", "fb", folders(tmp_path), RUN_AT, path=str(tmp_path / "tb"))
    assert (used, spark.read.table(name).count()) == ("table", 2)
    assert "ingestion_timestamp" in spark.read.table(name).columns
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError, match="unknown tier"):
        tiers.write_with_fallback(spark.range(1), "tin", "fb", folders(tmp_path), RUN_AT)


def test_rejected_data_comes_with_its_issues(spark, sf_dir, tmp_path):
    feed = views.customer_src(spark, sf_dir)
    issues = issue_rows(validate(feed, CUSTOMER_V2))
    path, issues_path = tiers.write_rejected(feed, issues, "customer_data", "r1", folders(tmp_path), RUN_AT)
    assert spark.read.parquet(path).count() == 150
    assert spark.read.parquet(issues_path).where("severity = 'error' AND run_id = 'r1'").count() == 2


def test_documents_are_written_and_counted(spark, tmp_path):
    rows = document_rows(spark.range(10), F.when(F.col("id") < 8, F.concat(F.lit("i"), F.col("id") % 2)), "id")
    assert document_sink.write_documents(rows, str(tmp_path)) == (8, 2)
    assert spark.read.text(str(tmp_path)).groupBy("_index").count().count() == 2


def test_metrics_are_stamped_once(spark, tmp_path):
    stamped = stamp_metrics(spark.createDataFrame([(1,)], "a int"), RUN_AT)
    assert stamp_metrics(stamped, RUN_AT + dt.timedelta(days=1)).first()["@timestamp"] == stamped.first()["@timestamp"]
    document_sink.write_metrics(stamped, str(tmp_path / "m"))
    assert [r["_index"] for r in spark.read.json(str(tmp_path / "m")).collect()] == ["metrics-2024.02.01"]


def test_message_rows(spark):
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    row = document_sink.to_kafka_rows(df, "t", moment=F.lit("1970-01-01 00:00:01.5").cast("timestamp_ntz")).first()
    assert (row["key"], row["value"]) == (None, '{"id":1,"v":"x","_timestamp":1500}')
    own = document_sink.to_kafka_rows(df.withColumn("_timestamp", F.lit(7)), "t", key=F.col("id")).first()
    assert (own["key"], own["value"]) == ("1", '{"id":1,"v":"x","_timestamp":7}')


def sales_source(path):
    return {"name": "sales_transactions", "type": "parquet", "path": path, "validation_rules": {"quantity": {"min": 1, "max": 10000}}}


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "sales")
    views.sales_src(spark, sf_dir).write.parquet(path)
    return path


def test_a_run_writes_data_results_and_reports(spark, landed, tmp_path):
    config = {
        "file_sources": [
            sales_source(landed),
            {"name": "broken", "type": "parquet", "path": f"{landed}-none"},
            {"name": "strange", "type": "xlsx", "path": landed},
        ],
        "kafka_sources": [{"name": "topic"}],
    }
    run = Run("r1", RUN_AT, folders(tmp_path / "data"), schemas=SCHEMAS, monitor_path=str(tmp_path / "mon"), documents_path=str(tmp_path / "docs"))
    results = {r["source_name"]: r for r in process_all(spark, config, run).collect()}
    assert {n: r["status"] for n, r in results.items()} == {
        "sales_transactions": "success", "broken": "failed", "strange": "failed", "topic": "failed",
    }
    sales = results["sales_transactions"]
    assert (sales["classification"], sales["record_count"], sales["schema_valid"]) == ("bronze", 6000, False)
    written = spark.read.parquet(str(tmp_path / "data" / "bronze" / "sales_transactions"))
    assert written.count() == 6000
    assert written.select("data_classification", "classification_level").distinct().collect() == [("bronze", "bronze")]
    monitor = str(tmp_path / "mon")
    assert spark.read.parquet(f"{monitor}/source_runs").count() == 4
    totals = spark.read.parquet(f"{monitor}/pipeline_runs").first()
    assert (totals["sources_processed"], totals["sources_failed"], totals["records_processed"], totals["bronze_count"]) == (1, 3, 6000, 6000)
    issues = {(r["column_name"], r["severity"]) for r in spark.read.parquet(f"{monitor}/issues").collect()}
    assert issues == {("payment_method", "warning"), ("quantity", "error")}
    assert spark.read.parquet(f"{monitor}/schema_events").first()["event_type"] == "schema_validated"
    assert spark.read.json(f"{monitor}/metrics").count() == 1
    assert spark.read.text(str(tmp_path / "docs")).count() == 6000


def test_failed_reports_do_not_fail_a_written_source(spark, landed, tmp_path):
    (tmp_path / "mon").write_text("a file where a folder should be")
    run = Run("r1", RUN_AT, folders(tmp_path / "data"), schemas=SCHEMAS, monitor_path=str(tmp_path / "mon"))
    assert process_source(spark, "file", {**sales_source(landed), "format": "parquet"}, run)[4] == "success"


def test_missing_target_path_fails_the_source(spark, landed):
    run = Run("r1", RUN_AT, {"gold": "/nowhere"})
    assert process_source(spark, "file", {**sales_source(landed), "format": "parquet"}, run)[4] == "failed"


def test_one_source_by_name(spark, landed):
    row = process_one(spark, {"file_sources": [sales_source(landed)]}, "sales_transactions", Run("r", RUN_AT)).first()
    assert (row["status"], row["classification"], row["schema_valid"]) == ("success", "bronze", True)


def test_the_evolved_frame_is_graded_and_returned(spark, sf_dir):
    source = {"name": "customer_data", "schema_version": 1, "target_schema_version": 2}
    graded, row = grade_source(views.customer_src(spark, sf_dir), source, Run("r", RUN_AT, schemas=SCHEMAS))
    assert "first_name" in graded.columns and "name" not in graded.columns
    assert row["cell_count"] == 150 * 14
    errors = {i["column_name"] for i in row["issues"] if i["severity"] == "error"}
    assert errors == {"postal_code"}  # new and empty, so nothing in it matches its pattern
    plain, _ = grade_source(views.customer_src(spark, sf_dir), {"name": "customer_data", "schema_version": 1}, Run("r", RUN_AT, schemas=SCHEMAS))
    assert "name" in plain.columns


def test_an_unknown_target_version_leaves_the_frame_alone(spark, sf_dir):
    from assayer.plans.batch import evolve_if_needed

    feed = views.customer_src(spark, sf_dir)
    same = evolve_if_needed(feed, {"name": "customer_data", "schema_version": 1, "target_schema_version": 7}, Run("r", RUN_AT, schemas=SCHEMAS))
    assert same is feed


def test_a_failing_evolution_leaves_the_frame_alone(spark):
    from assayer.operators.schema import Field, SchemaDefinition
    from assayer.plans.batch import evolve_if_needed

    schemas = {
        ("s", 1): SchemaDefinition("s", 1, (Field("a", "array", element_type="int"),)),
        ("s", 2): SchemaDefinition("s", 2, (Field("a", "date"),)),
    }
    df = spark.createDataFrame([([1],)], "a array<int>")
    source = {"name": "s", "schema_version": 1, "target_schema_version": 2}
    assert evolve_if_needed(df, source, Run("r", RUN_AT, schemas=schemas)) is df


def test_a_source_without_schema_is_valid_with_a_warning(spark):
    graded, row = grade_source(spark.range(3), {"name": "new"}, Run("r", RUN_AT))
    assert (row["schema_valid"], row["schema_error_count"], row["schema_warning_count"]) == (True, 0, 1)
    assert graded.first()["source_name"] == "new"


def test_invalid_schema_caps_perfect_data(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 2, 1))], "x int, t timestamp_ntz")
    source = {"name": "customer_data", "schema_version": 1, "datetime_column": "t"}
    _, row = grade_source(df, source, Run("r", RUN_AT, schemas=SCHEMAS))
    assert (row["completeness"], row["accuracy"], row["timeliness"]) == (1.0, 1.0, 1.0)
    assert row["data_classification"] == "bronze"
    _, free = grade_source(df, {**source, "name": "free"}, Run("r", RUN_AT))
    assert free["data_classification"] == "gold"


def test_own_thresholds_of_a_source(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    source = {"name": "s", "classification_thresholds": {"bronze": {"completeness": 0.5, "accuracy": 0.5}}}
    assert grade_source(df, source, Run("r", RUN_AT))[1]["data_classification"] == "bronze"
    assert grade_source(df, {"name": "s"}, Run("r", RUN_AT))[1]["data_classification"] == "rejected"


def test_landed_api_and_feed_sources(spark, sf_dir, tmp_path):
    api, nvd = str(tmp_path / "api"), str(tmp_path / "nvd")
    views.api_pages(spark, sf_dir).write.parquet(api)
    views.cve_pages(spark, sf_dir).write.parquet(nvd)
    items = read_source(
        spark, "api",
        {"path": api, "element": views.ITEM, "results_path": "data.items", "pagination": {"has_more_path": "meta.has_more"}},
    )
    assert items.columns == ["id", "v", "kind"]
    inferred = read_source(spark, "api", {"path": api, "results_path": "data.items", "pagination": {"has_more_path": "meta.has_more"}})
    assert sorted(map(tuple, inferred.select("id", "kind").collect())) == sorted(map(tuple, items.select("id", "kind").collect()))
    (tmp_path / "a.csv").write_text("a,b\n1,x\n")
    (tmp_path / "a.xml").write_text("<rows><r><a>1</a></r></rows>")
    assert read_source(spark, "api", {"path": str(tmp_path / "a.csv"), "response_format": "csv"}).dtypes == [("a", "int"), ("b", "string")]
    assert read_source(spark, "api", {"path": str(tmp_path / "a.xml"), "response_format": "xml", "xml_row_tag": "r"}).first()["a"] == 1
    with pytest.raises(ValueError, match="unsupported response format"):
        read_source(spark, "api", {"path": "x", "response_format": "yaml"})
    records = read_source(
        spark, "nvd",
        {"path": nvd, "results_per_page": 20, "start_date": "2023-01-01T00:00:00.000", "additional_query_params": {"cvssV3Severity": "HIGH"}},
    )
    assert 0 < records.count() < 200
    with pytest.raises(ValueError, match="unknown source family"):
        read_source(spark, "ftp", {})


def test_column_profile_table(spark, sf_dir, tmp_path):
    profile_source(views.customer_src(spark, sf_dir), "customer_data", Run("r", RUN_AT, monitor_path=str(tmp_path)))
    assert spark.read.parquet(str(tmp_path / "column_profile")).where("source_name = 'customer_data'").count() == 7


def test_registry_of_a_run(spark, sf_dir, tmp_path):
    from assayer.operators import registry

    path = str(tmp_path / "registry")
    run = Run("r", RUN_AT, registry_path=path)
    _, first = grade_source(views.sales_src(spark, sf_dir), {"name": "sales_transactions"}, run)
    assert (first["schema_valid"], first["schema_warning_count"]) == (True, 1)
    assert registry.get_version(spark, path, "sales_transactions").by_name.keys() == SALES_V1.by_name.keys()
    _, second = grade_source(views.sales_src(spark, sf_dir), {"name": "sales_transactions"}, run)
    assert (second["schema_valid"], second["schema_warning_count"]) == (True, 0)
    registry.register_version(spark, path, SALES_V1)
    _, third = grade_source(views.sales_src(spark, sf_dir), {"name": "sales_transactions", "schema_version": "v1"}, run)
    assert not third["schema_valid"]
