"""Publication: one write, one visible copy of every run, whatever its grade was before."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from assayer.plans.batch import Run, process_all, process_source
from assayer.session import claim_path, list_folders, remove_path
from assayer.sinks import published as store
from assayer.sinks import tiers

RUN_AT = dt.datetime(2024, 2, 1)


def folders(path):
    return {t: f"{path}/{t}" for t in ("gold", "silver", "bronze", "rejected")}


def source(path, name="feed one"):
    return {"name": name, "type": "parquet", "path": str(path), "datetime_column": "day", "classification_rules": {"timeliness": 1000}}


def feed(spark, path, rows, filled):
    value = F.when(F.col("id") < filled, F.col("id"))
    days = spark.range(rows).select("id", value.alias("value"), value.alias("other"), F.lit(RUN_AT).cast("timestamp_ntz").alias("day"))
    days.write.mode("overwrite").parquet(str(path))


def test_data_is_written_once_where_it_stays(spark, tmp_path, monkeypatch):
    feed(spark, tmp_path / "in", 20, 20)
    shared = tmp_path / "shared"
    monkeypatch.setattr("assayer.plans.batch.fresh_path", lambda spark, label: f"{shared}/{label}")
    run = Run("r", RUN_AT, store_path=str(tmp_path / "store"), monitor_path=str(tmp_path / "monitor"))
    result = process_source(spark, "file", source(tmp_path / "in") | {"format": "parquet"}, run)
    assert result[4:7] == ("success", "gold", 20)
    assert not shared.exists()
    assert len(list_folders(spark, store.source_folder(run.store_path, "feed one"))) == 1
    rows = store.published(spark, run.store_path, "feed one")
    assert rows.columns == ["id", "value", "other", "day", *store.QUALITY, "run_id"]
    first = rows.first()
    assert (first["data_classification"], first["source_name"], first["processing_timestamp"], first["run_id"]) == ("gold", "feed one", RUN_AT, "r")


def test_a_regraded_run_shows_one_copy(spark, tmp_path):
    kept = str(tmp_path / "store")
    for filled in (20, 2, 20, 5):
        feed(spark, tmp_path / "in", 20, filled)
        process_all(spark, {"file_sources": [source(tmp_path / "in")]}, Run("r", RUN_AT, store_path=kept)).collect()
    feed(spark, tmp_path / "in", 7, 7)
    process_all(spark, {"file_sources": [source(tmp_path / "in")]}, Run("s", RUN_AT, store_path=kept)).collect()
    assert store.published(spark, kept, "feed one", run_id="r").count() == 20
    assert store.published(spark, kept, "feed one", run_id="r").where("value is not null").count() == 5
    assert store.published(spark, kept, "feed one", tier="gold").select("run_id").distinct().collect() == [("s",)]
    store.regrade(spark, kept, "feed one", "s", "bronze")
    assert store.published(spark, kept, "feed one", tier="gold").count() == 0 and store.published(spark, kept, "feed one").count() == 27
    assert store.retire(spark, kept, "feed one") == 3 and store.retire(spark, kept, "feed one") == 0
    assert store.published(spark, kept, "feed one").count() == 27
    with pytest.raises(ValueError, match="has not published"):
        store.regrade(spark, kept, "feed one", "t", "gold")
    with pytest.raises(ValueError, match="not been published"):
        store.published(spark, kept, "other")


def test_a_write_that_was_not_committed_is_not_seen(spark, tmp_path):
    kept = str(tmp_path)
    attempt, seen = store.write_attempt(spark.range(5), kept, "s", [F.count("*").alias("n")])
    assert seen == {"n": 5} and store.published(spark, kept, "s").count() == 0
    assert store.manifest(spark, kept).count() == 0 and store.retire(spark, kept, "s") == 1
    assert attempt.startswith("a-")


def test_tier_files_keep_one_copy_of_a_run(spark, tmp_path):
    paths = folders(tmp_path)
    for filled, day in ((20, 1), (2, 1), (20, 1), (20, 2)):
        feed(spark, tmp_path / "in", 20, filled)
        process_all(spark, {"file_sources": [source(tmp_path / "in", "f")]}, Run("r", dt.datetime(2024, 2, day), paths)).collect()
    assert spark.read.parquet(f"{paths['gold']}/f").count() == 20
    copies = [f"{d}/{x}" for t in paths for d, ds, _ in os.walk(f"{paths[t]}/f") for x in ds if x.startswith("ingestion_run")]
    assert copies == [f"{paths['gold']}/f/ingestion_date=2024-02-02/ingestion_run=r"]


def test_tier_tables_keep_one_copy_of_a_run(spark, tmp_path):
    where = {"prefix": "once_", "path": None}
    for tier, rows, day, run in (("gold", 3, 1, "a b"), ("gold", 3, 1, "a b"), ("gold", 4, 1, "a b"), ("gold", 5, 1, "other"), ("silver", 6, 1, "a b"), ("silver", 7, 2, "a b")):
        at = dt.date(2024, 2, day)
        tiers.write_tier_table(spark.range(rows), tier, "s", at, run_id=run, prefix="once_", path=str(tmp_path / tier))
        tiers.retire_older_partitions(spark, tier, "s", at, run, **where)
    gold, silver = (spark.read.table(f"once_{t}_s") for t in ("gold", "silver"))
    assert {(r["ingestion_run"], r["count"]) for r in gold.groupBy("ingestion_run").count().collect()} == {("other", 5)}
    assert {(r["ingestion_run"], r["day"], r["count"]) for r in silver.groupBy("ingestion_run", "day").count().collect()} == {("a%20b", 2, 7)}
    for name in ("once_gold_s", "once_silver_s"):
        spark.sql(f"DROP TABLE {name}")


def test_folders_are_listed_claimed_and_removed(spark, tmp_path):
    assert list_folders(spark, str(tmp_path / "none")) == [] and not remove_path(spark, str(tmp_path / "none"))
    assert claim_path(spark, str(tmp_path / "a" / "b")) and not claim_path(spark, str(tmp_path / "a" / "b"))
    assert list_folders(spark, str(tmp_path)) == ["a"] and remove_path(spark, str(tmp_path / "a"))
