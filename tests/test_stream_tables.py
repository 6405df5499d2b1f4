"""Update results, progress tables and profiles that add up."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from assayer.operators import sketches
from assayer.plans import views
from assayer.streaming import batches, progress
from assayer.streaming.runs import read_table_stream, run_available, start_sink


def counts(df):
    return sorted(tuple(r) for r in df.collect())


def test_updates_replayed_and_folded(spark, tmp_path):
    path, keep = str(tmp_path / "u"), batches.upsert_result(str(tmp_path / "u"))
    make = lambda rows: spark.createDataFrame(rows, "k string, n int")
    with pytest.raises(ValueError, match="not delivered"):
        batches.read_updates(spark, path, ["k"])
    batches.fold_updates(spark, path, ["k"])
    keep(make([("a", 1), ("b", 1), (None, 1)]), 0)
    keep(make([("a", 3)]), 1)
    keep(make([("a", 2)]), 1)  # the batch comes again, otherwise
    keep(make([]), 2)
    expected = [(None, 1), ("a", 2), ("b", 1)]
    key = lambda rows: sorted(rows, key=repr)
    for _ in range(2):
        assert key(tuple(r) for r in batches.read_updates(spark, path, ["k"]).collect()) == key(expected)
        batches.fold_updates(spark, path, ["k"])
    assert [d for d in os.listdir(path) if d.startswith("batch_id")] == ["batch_id=-2"]
    keep(make([("a", 2)]), 1)  # after the fold, too
    keep(make([("b", 5)]), 3)
    assert key(tuple(r) for r in batches.read_updates(spark, path, ["k"]).collect()) == key([(None, 1), ("a", 2), ("b", 5)])
    batches.fold_updates(spark, path, ["k"])
    os.remove(f"{path}/batch_id=-4/_SUCCESS")  # a fold that broke off
    keep(make([("b", 6)]), 4)
    batches.fold_updates(spark, path, ["k"])
    assert key(tuple(r) for r in batches.read_updates(spark, path, ["k"]).collect()) == key([(None, 1), ("a", 2), ("b", 6)])


def test_progress_of_runs_and_failures(spark, tmp_path, sf_dir):
    os.makedirs(tmp_path / "in")
    views.table(spark, sf_dir, "events").repartition(3).write.parquet(str(tmp_path / "in" / "events.parquet"))
    stream = read_table_stream(spark, str(tmp_path / "in"), "events", files_per_trigger=1)
    log = progress.ProgressLog(spark, str(tmp_path / "log"), rows_at_once=2)
    spark.streams.addListener(log)
    try:
        good = start_sink(stream, "good", str(tmp_path / "c"), trigger=None, handler=batches.write_batches(str(tmp_path / "out")))
        run_available(good)
        bad = start_sink(stream, "bad", str(tmp_path / "c"), trigger=None, handler=lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            run_available(bad)
        log.close([good, bad])
        log.close()
    finally:
        spark.streams.removeListener(log)
    rows = progress.read_progress(spark, str(tmp_path / "log"))
    found = {r["query_id"]: r for r in progress.progress_summary(rows).collect()}
    total = views.table(spark, sf_dir, "events").count()
    assert (found[str(good.id)]["batches"], found[str(good.id)]["input_rows"], found[str(good.id)]["failures"], found[str(good.id)]["runs"]) == (3, total, 0, 1)
    assert found[str(good.id)]["query_name"] == "good" and found[str(bad.id)]["failures"] == 1 and found[str(bad.id)]["message"]
    assert rows.where("event = 'failed'").first()["query_name"] == "bad"
    assert progress.read_progress(spark, str(tmp_path / "none")).count() == 0


def test_profiles_add_up(spark, tmp_path):
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 1000).cast("double").alias("n"), F.when(F.col("id") % 5 == 0, "").otherwise(F.concat(F.lit("v"), F.col("id") % 700)).alias("a.b"),
        F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id") / 2).alias("x"), (F.col("id") % 2 == 0).alias("f"), F.array("id").alias("list"),
        F.lit(None).cast("string").alias("none"), (F.col("id") % 6).alias("part"))
    whole = sketches.profile_from_sketches(sketches.profile_sketches(df.drop("part")))
    merged = sketches.profile_from_sketches(sketches.merge_sketches(sketches.profile_sketches(df, by=["part"])))
    for found in ({r["column_name"]: r for r in p.collect()} for p in (whole, merged)):
        assert set(found) == {"id", "n", "a.b", "x", "f", "list", "none"}
        assert all(r["record_count"] == 20_000 for r in found.values())
        assert (found["n"]["null_count"], found["n"]["min_value"], found["n"]["max_value"]) == (6667, 0.0, 999.0)
        assert abs(found["n"]["distinct_count"] - 1001) <= 30 and abs(found["a.b"]["distinct_count"] - 561) <= 18
        assert found["a.b"]["empty_count"] == 4000 and found["a.b"]["quantiles"] is None
        assert found["x"]["nan_count"] == 2858 and found["x"]["max_value"] == 9999.0
        assert abs(found["x"]["quantiles"][1] - 5000) < 200 and abs(found["id"]["distinct_count"] - 20_000) < 600
        assert found["f"]["true_count"] == 10_000 and found["f"]["distinct_count"] == 2
        assert found["list"]["distinct_count"] is None and (found["none"]["distinct_count"], found["none"]["completeness"]) == (1, 0.0)
    grouped = sketches.profile_from_sketches(sketches.merge_sketches(sketches.profile_sketches(df, ["n"], ["part"]), ["part"]), ["part"])
    assert grouped.count() == 6 and grouped.agg(F.sum("record_count")).first()[0] == 20_000
    plan = sketches.profile_sketches(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
