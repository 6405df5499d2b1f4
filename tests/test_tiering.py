from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from assayer.operators import tiering
from assayer.operators.scoring import TIER_THRESHOLDS, QualitySpec

RUN_AT = dt.datetime(2024, 2, 1, 12, 30)
RANK = {"rejected": 0, "bronze": 1, "silver": 2, "gold": 3}


def tiers(spark, rows, thresholds=TIER_THRESHOLDS, valid=True):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, completeness double, accuracy double, timeliness double")
    graded = tiering.classify(df, thresholds, F.lit(valid)).orderBy("i").collect()
    return [r["data_classification"] for r in graded]


def test_thresholds_are_inclusive(spark):
    rows = [(0.95, 0.9, 0.85), (0.8, 0.8, 0.7), (0.7, 0.6, 0.5), (0.7, 0.6, 0.4999)]
    assert tiers(spark, rows) == ["gold", "silver", "bronze", "rejected"]


def test_every_metric_must_reach_its_threshold(spark):
    assert tiers(spark, [(0.94, 1.0, 1.0), (1.0, 0.79, 1.0), (1.0, 1.0, 0.69)]) == ["silver", "bronze", "bronze"]


def test_invalid_schema_reaches_bronze_at_most(spark):
    assert tiers(spark, [(1.0, 1.0, 1.0), (0.1, 1.0, 1.0)], valid=False) == ["bronze", "rejected"]


def test_no_thresholds_hold_and_unknown_metrics_count_as_zero(spark):
    assert tiers(spark, [(0.0, 0.0, 0.0)], {"gold": {}}) == ["gold"]
    assert tiers(spark, [(1.0, 1.0, 1.0)], {"gold": {"beauty": 0.1}, "silver": {"beauty": 1}, "bronze": {"beauty": 0}}) == ["bronze"]


def test_a_metric_without_value_counts_as_zero(spark):
    assert tiers(spark, [(None, 1.0, 1.0)]) == ["rejected"]


def test_better_metrics_never_lower_the_tier(spark):
    steps = [0.0, 0.5, 0.65, 0.75, 0.82, 0.9, 1.0]
    grid = list(itertools.product(steps, repeat=3))
    ranked = dict(zip(grid, [RANK[t] for t in tiers(spark, grid)], strict=True))
    for point, rank in ranked.items():
        for axis in range(3):
            higher = [s for s in steps if s > point[axis]]
            if higher:
                better = point[:axis] + (higher[0],) + point[axis + 1 :]
                assert ranked[better] >= rank


def test_override_replaces_single_metrics_only():
    merged = tiering.merge_thresholds(TIER_THRESHOLDS, {"bronze": {"timeliness": 0.7}})
    assert merged["bronze"] == {"completeness": 0.7, "accuracy": 0.6, "timeliness": 0.7}
    assert merged["gold"] == TIER_THRESHOLDS["gold"]
    assert TIER_THRESHOLDS["bronze"]["timeliness"] == 0.5
    assert tiering.merge_thresholds(TIER_THRESHOLDS, None) == TIER_THRESHOLDS


def test_quality_columns_come_in_order(spark):
    row = {
        "data_classification": "gold", "completeness": 1.0, "accuracy": 0.9, "timeliness": 0.5,
        "schema_valid": True, "schema_error_count": 0, "schema_warning_count": 2,
    }
    df = tiering.add_quality_columns(spark.range(1), row, "s", RUN_AT)
    assert df.columns == [
        "id", "data_classification", "metric_completeness", "metric_accuracy", "metric_timeliness",
        "schema_valid", "schema_error_count", "schema_warning_count", "processing_timestamp", "source_name",
    ]
    assert df.first()["processing_timestamp"] == RUN_AT


def test_group_quality_columns_match_null_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, None)], "g string, n int")
    graded = tiering.tier(df, QualitySpec(), by=["g"])
    rows = tiering.add_group_quality_columns(df, graded, ["g"]).collect()
    assert {(r["g"], r["metric_completeness"]) for r in rows} == {("a", 1.0), (None, 0.25)}


def test_group_quality_columns_without_broadcast(spark):
    df = spark.range(100).hint("merge").withColumn("g", F.col("id") % 10)
    joined = tiering.add_group_quality_columns(df, tiering.tier(df, QualitySpec(), by=["g"]), ["g"])
    assert joined.count() == 100
    assert joined.where("data_classification IS NULL").count() == 0


@pytest.mark.parametrize("text", ["2024-2", "yesterday", "2024-13-01", "01/02/2024"])
def test_date_parts_leave_the_frame_alone_if_there_is_no_date(spark, text):
    assert tiering.add_date_parts(spark.range(1), text).columns == ["id"]


def test_date_parts_as_configured(spark):
    df = tiering.add_date_parts(spark.range(1), "2024-02-03", ("day", "year", "hour"))
    assert df.columns == ["id", "day", "year"]
    assert df.first()[1:] == (3, 2024)
    assert dict(df.dtypes)["day"] == "int"


def test_ingest_columns_and_stamps(spark):
    row = tiering.add_ingest_columns(spark.range(1), "gold", RUN_AT).first()
    assert (row["ingestion_timestamp"], row["classification_level"]) == (RUN_AT, "gold")
    stamped = tiering.stamp_events(spark.range(1), "s", F.lit("2024-02-01 03:04:05").cast("timestamp")).first()
    assert (stamped["source_name"], stamped["timestamp"]) == ("s", "2024-02-01 03:04:05")


def test_thresholds_from_a_table_grade_like_thresholds_from_settings(spark):
    own = {
        "a": TIER_THRESHOLDS,
        "b": tiering.merge_thresholds(TIER_THRESHOLDS, {"gold": {"timeliness": 0.99}}),
        "c": {"gold": {"beauty": 0.1}, "bronze": {"completeness": 0.3}},  # no silver thresholds: silver holds
        "d": {"gold": {"completeness": 2.0}, "silver": {"beauty": 1}, "bronze": {"accuracy": 0.5}},
    }
    values = [(0.96, 0.95, 0.9), (0.85, 0.85, 0.75), (0.75, 0.65, 0.55), (0.2, 0.2, 0.2)]
    rows = [(s, i, *v) for s in own for i, v in enumerate(values)]
    scores = spark.createDataFrame(rows, "s string, i int, completeness double, accuracy double, timeliness double")
    table = spark.createDataFrame(
        [(s, t, m, float(v)) for s, tiers_ in own.items() for t, ms in tiers_.items() for m, v in ms.items()],
        "s string, tier string, metric string, least double",
    )
    found = {(r["s"], r["i"]): r["data_classification"] for r in tiering.classify_by_table(scores, table, ["s"]).collect()}
    for source, thresholds in own.items():
        assert [found[source, i] for i in range(4)] == tiers(spark, values, thresholds)
    capped = tiering.classify_by_table(scores, table, ["s"], F.lit(False)).collect()
    assert {r["data_classification"] for r in capped} <= {"bronze", "rejected"}
