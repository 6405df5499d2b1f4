"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

from assayer.operators.checks import validate
from assayer.operators.profile import profile_columns
from assayer.plans import load_queries, views
from assayer.plans.batch import assess
from assayer.plans.definitions import CUSTOMER_V1
from assayer.operators.scoring import QualitySpec

QUERIES, _ = load_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> int:
    return plan(df).count("FileScan")


def test_everything_known_of_a_dataset_comes_from_one_scan(spark, sf_dir):
    feed = views.customer_src(spark, sf_dir)
    spec = QualitySpec(rules={"email": {"pattern": "@"}, "acctbal": {"min": 0, "max": 1}}, date_column="created_at")
    assert scans(assess(feed, spec, CUSTOMER_V1)) == 1
    assert scans(validate(feed, CUSTOMER_V1)) == 1
    assert scans(profile_columns(feed, distinct="approx")) == 1


def test_aggregates_shuffle_partial_results_once(spark, sf_dir):
    for name in ("tier_by_group", "run_totals_by_day", "latest_status"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert text.count("Exchange") == 1, name
        assert "partial_" in text, name


@pytest.mark.parametrize(
    ("name", "pushed"),
    [("date_range_filter", "GreaterThanOrEqual(o_orderdate"), ("retention", "GreaterThanOrEqual(ts"),
     ("incremental_load", "Or(IsNull(ts),GreaterThanOrEqual(ts"), ("event_filter", "In(event_type"), ("document_search", "EqualTo(lang,en)")],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in plan(QUERIES[name](spark, sf_dir))


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["accuracy_range"](spark, sf_dir))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(read) == sorted(
        ["l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double", "o_orderkey:bigint", "p_partkey:bigint"]
    )


def test_newest_rows_are_not_sorted_as_a_whole(spark, sf_dir):
    for name in ("recent_events", "recent_activity", "document_search", "first_sources"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir)), name


def test_no_python_workers_and_no_cross_joins(spark, sf_dir):
    for name, query in QUERIES.items():
        if not name.startswith(("stream_", "process_", "scan_")):
            text = plan(query(spark, sf_dir))
            assert "Python" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
