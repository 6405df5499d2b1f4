"""Known values of the small tables."""

from __future__ import annotations

import pytest

from assayer.plans import load_queries

QUERIES, _ = load_queries()


def only_row(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    ("name", "column", "value"),
    [
        ("completeness", "completeness", 0.9524),
        ("accuracy_range", "accuracy", 0.9820),
        ("accuracy_pattern", "accuracy", 0.9838),
        ("accuracy_enum", "accuracy", 0.9750),
        ("accuracy_combined", "accuracy", 0.9320),
        ("accuracy_default", "accuracy", 0.9686),
        ("timeliness", "timeliness", 0.4335),
    ],
)
def test_scores(spark, sf_dir, name, column, value):
    assert only_row(spark, sf_dir, name)[column] == pytest.approx(value, abs=5e-5)


def test_missing_counts(spark, sf_dir):
    row = only_row(spark, sf_dir, "missing_counts")
    assert (row["name_missing"], row["phone_missing"], row["acctbal_missing"], row["record_count"]) == (12, 30, 8, 150)


def test_tiers(spark, sf_dir):
    assert only_row(spark, sf_dir, "tier_classify")["data_classification"] == "bronze"
    rows = {r["source_name"]: r for r in QUERIES["tier_by_group"](spark, sf_dir).collect()}
    click = rows["feed-click"]
    assert click["data_classification"] == "silver"
    assert (click["completeness"], click["accuracy"], click["timeliness"]) == pytest.approx((0.9924, 0.9762, 0.7285), abs=5e-5)


def test_pattern_and_range(spark, sf_dir):
    phone = {r["column_name"]: r for r in QUERIES["pattern_validation"](spark, sf_dir).collect()}["phone"]
    assert (phone["match_count"], phone["total_count"], phone["severity"]) == (103, 150, "warning")
    quantity = {r["column_name"]: r for r in QUERIES["range_validation"](spark, sf_dir).collect()}["quantity"]
    assert (quantity["actual_min"], quantity["actual_max"], quantity["in_range"]) == (0, 50, False)


def test_profile(spark, sf_dir):
    row = {r["column_name"]: r for r in QUERIES["profile_columns"](spark, sf_dir).collect()}["payment_method"]
    assert (row["record_count"], row["null_count"], row["non_null_count"]) == (6000, 1149, 4851)
    assert (row["empty_count"], row["distinct_count"]) == (0, 5)
    assert row["completeness"] == pytest.approx(0.8085)


def test_run_totals_and_messages(spark, sf_dir):
    row = only_row(spark, sf_dir, "run_totals")
    assert (row["sources_processed"], row["sources_failed"], row["records_processed"]) == (600, 201, 235651)
    assert (row["gold_count"], row["rejected_count"]) == (86893, 3702)
    stats = only_row(spark, sf_dir, "validation_stats")
    assert (stats["valid_count"], stats["invalid_count"], stats["total_count"], stats["valid_percentage"]) == (600, 400, 1000, 60)
    split = only_row(spark, sf_dir, "bad_json_split")
    assert (split["dead_letter"], split["parsed"], split["empty_value"]) == (20, 933, 47)
