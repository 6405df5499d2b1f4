from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from assayer.operators import scoring, tiering
from assayer.operators.scoring import QualitySpec

AS_OF = dt.date(2024, 2, 1)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_no_rows_scores_zero_and_neutral_time(spark):
    empty = spark.createDataFrame([], "a int, t timestamp_ntz")
    row = one(scoring.score(empty, QualitySpec(rules={"a": {"min": 0, "max": 1}}, date_column="t"), AS_OF))
    assert (row["completeness"], row["accuracy"], row["timeliness"]) == (0.0, 0.0, 0.5)
    assert row["record_count"] == row["missing_cells"] == row["violations"] == 0


def test_no_columns_scores_zero(spark):
    row = one(scoring.score(spark.range(3).select(), QualitySpec(), AS_OF))
    assert (row["completeness"], row["accuracy"]) == (0.0, 0.0)


def test_null_and_nan_are_missing_but_the_word_nan_is_not(spark):
    df = spark.createDataFrame(
        [(None, math.nan, "NaN", None), (1, 2.0, None, dt.date(2024, 1, 1))], "i int, d double, s string, day date"
    )
    row = one(scoring.count_cells(df, QualitySpec()))
    assert (row["missing_cells"], row["cell_count"]) == (4, 8)


def test_nan_counts_as_missing_in_a_column_declared_without_nulls(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("d", T.DoubleType(), False)])
    df = spark.createDataFrame([(math.nan,), (1.0,)], schema)
    assert one(scoring.count_cells(df, QualitySpec()))["missing_cells"] == 1


def test_one_cell_may_break_three_rules_and_null_breaks_none(spark):
    df = spark.createDataFrame([("zz",), (None,), ("b",)], "s string")
    rules = {"s": {"min": "a", "max": "c", "pattern": "^[a-c]$", "allowed_values": ["a", "b"]}}
    row = one(scoring.score(df, QualitySpec(rules=rules)))
    assert row["violations"] == 3
    assert row["accuracy"] == pytest.approx(0.0)


def test_accuracy_may_fall_below_zero(spark):
    df = spark.createDataFrame([("zz",)], "s string")
    rules = {"s": {"min": "a", "max": "c", "pattern": "^[a-c]$", "allowed_values": ["a"]}}
    assert one(scoring.score(df, QualitySpec(rules=rules)))["accuracy"] == pytest.approx(-2.0)


def test_rules_need_both_bounds_and_a_known_column(spark):
    df = spark.createDataFrame([(5,)], "n int")
    row = one(scoring.score(df, QualitySpec(rules={"n": {"min": 10}, "other": {"pattern": "x"}})))
    assert (row["violations"], row["accuracy"]) == (0, 1.0)


def test_without_rules_accuracy_is_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "n int, s string")
    row = one(scoring.score(df, QualitySpec()))
    assert row["accuracy"] == row["completeness"] == 0.75


def test_rules_on_columns_of_another_type(spark):
    df = spark.createDataFrame([("5", 12), ("50", 7), ("many", 12), (None, None)], "s string, n int")
    rules = {"s": {"min": 1, "max": 10, "allowed_values": [5, 6]}, "n": {"pattern": "^1"}}
    assert one(scoring.score(df, QualitySpec(rules=rules)))["violations"] == 3


def test_numbers_as_dates_are_seconds(spark):
    df = spark.createDataFrame([(int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp()),)], "t bigint")
    assert one(scoring.count_cells(df, QualitySpec(date_column="t"), AS_OF))["age_days"] == 1


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(1,), (10,), (0,), (11,)], "n int")
    assert one(scoring.score(df, QualitySpec(rules={"n": {"min": 1, "max": 10}})))["violations"] == 2


@pytest.mark.parametrize(
    ("days", "expected"),
    [(0, 1.0), (15, 0.5), (30, 0.0), (90, 0.0), (-5, 1.0)],
)
def test_timeliness_is_clamped(spark, days, expected):
    df = spark.createDataFrame([(AS_OF - dt.timedelta(days=days),)], "d date")
    assert one(scoring.score(df, QualitySpec(date_column="d"), AS_OF))["timeliness"] == pytest.approx(expected)


def test_unreadable_dates_are_left_out_of_the_average(spark):
    df = spark.createDataFrame([("2024-01-17",), ("not a date",), (None,), ("",)], "d string")
    assert one(scoring.score(df, QualitySpec(date_column="d"), AS_OF))["timeliness"] == pytest.approx(0.5)


def test_only_unreadable_dates_are_neutral(spark):
    df = spark.createDataFrame([("soon",)], "d string")
    assert one(scoring.score(df, QualitySpec(date_column="d"), AS_OF))["timeliness"] == 0.5


def test_days_are_calendar_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59),)], "t timestamp_ntz")
    assert one(scoring.count_cells(df, QualitySpec(date_column="t"), dt.datetime(2024, 2, 1, 0, 1)))["age_days"] == 1


def test_absent_date_column_is_neutral_or_fresh_for_streams(spark):
    df = spark.range(2)
    assert one(scoring.score(df, QualitySpec(date_column="t")))["timeliness"] == 0.5
    assert one(scoring.score(df, QualitySpec(date_column="t", streaming=True)))["timeliness"] == 1.0


def test_counts_of_parts_add_up_to_the_whole(spark):
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("n"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("s"),
        F.date_sub(F.lit(AS_OF), (F.col("id") % 50).cast("int")).alias("d"),
    )
    spec = QualitySpec(rules={"n": {"min": 1, "max": 5}}, date_column="d")
    whole = one(scoring.score(df, spec, AS_OF))
    parts = scoring.count_cells(df.where("n < 2"), spec, AS_OF).unionByName(scoring.count_cells(df.where("n >= 2"), spec, AS_OF))
    merged = one(scoring.scores_from_counts(scoring.merge_counts(parts), spec, True))
    assert merged.asDict() == pytest.approx(whole.asDict())


def test_groups_score_like_datasets_of_their_own(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "g string, n int")
    grouped = {r["g"]: r["completeness"] for r in scoring.score(df, QualitySpec(), by=["g"]).collect()}
    assert grouped == {"a": 0.75, "b": 1.0}


def test_own_metrics_ride_in_the_same_scan(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "n int")
    spec = QualitySpec(metrics={"uniqueness": F.count_distinct("n") / F.count("n")}, thresholds={"gold": {"uniqueness": 0.9}})
    row = one(tiering.tier(df, spec))
    assert row["uniqueness"] == pytest.approx(2 / 3)
    assert row["data_classification"] == "silver"  # silver has no thresholds, and no thresholds hold


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([(None, 1)], "`a.b` string, `c d` int")
    assert one(scoring.count_cells(df, QualitySpec(rules={"c d": {"min": 2, "max": 3}}))).asDict()["violations"] == 1


def test_wide_tables_do_not_nest_deeply(spark):
    df = spark.range(2).select(*[F.lit(None).cast("int").alias(f"c{i}") for i in range(1500)])
    assert one(scoring.count_cells(df, QualitySpec()))["missing_cells"] == 3000


def test_rule_breaches_name_each_broken_rule(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "ok")], "id int, s string")
    rows = scoring.rule_breaches(df, {"s": {"pattern": "^ok$", "allowed_values": ["ok"]}}, ["id"]).collect()
    assert sorted(r["issue_type"] for r in rows) == ["allowed_values", "pattern"]
    assert {r["id"] for r in rows} == {1}
    assert scoring.rule_breaches(df, {}, ["id"]).count() == 0


def test_metrics_long(spark):
    scores = scoring.score(spark.createDataFrame([(None,), (1,), (2,)], "n int"), QualitySpec())
    rows = {r["metric"]: r["score"] for r in scoring.metrics_long(scores).collect()}
    assert rows == {"completeness": 0.6667, "accuracy": 0.6667, "timeliness": 0.5}
