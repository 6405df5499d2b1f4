from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from assayer.operators import checks, profile
from assayer.operators.schema import Field, SchemaDefinition
from assayer.plans.definitions import CUSTOMER_V1, CUSTOMER_V2, SALES_V1


def definition(*fields, patterns=None, ranges=None):
    return SchemaDefinition("s", 1, tuple(fields), patterns or {}, ranges or {})


def issues(df, schema):
    rows = checks.issue_rows(checks.validate(df, schema)).collect()
    return {(r["column_name"], r["issue_type"], r["severity"]) for r in rows}


def test_fields(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a bigint, b double, extra string")
    schema = definition(
        Field("a", "integer"), Field("b", "integer"), Field("c", "string", nullable=False), Field("d", "string")
    )
    assert issues(df, schema) == {
        ("b", "type", "error"), ("c", "missing", "error"), ("d", "missing", "warning"), ("extra", "extra", "warning"),
    }
    assert not checks.fields_conform(df.schema, schema)


def test_all_extra_fields_make_one_warning(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, x int, y int")
    row = checks.validate(df, definition(Field("a", "int"))).first()
    assert (row["schema_valid"], row["schema_error_count"], row["schema_warning_count"]) == (True, 0, 1)
    assert len(row["issues"]) == 2


@pytest.mark.parametrize(
    ("hits", "expected"),
    [(10, set()), (9, set()), (8, {"warning"}), (5, {"warning"}), (4, {"warning", "error"}), (0, {"warning", "error"})],
)
def test_pattern_severity_bounds(spark, hits, expected):
    df = spark.range(10).select(F.when(F.col("id") < hits, "ok").otherwise("no").alias("c"))
    found = issues(df, definition(Field("c", "string"), patterns={"c": "^ok$"}))
    assert {severity for _, _, severity in found} == expected


def test_null_and_empty_matches_are_no_hits(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "c string")
    row = checks.pattern_validation(df, {"c": "a*"}).first()
    assert (row["match_count"], row["total_count"], row["severity"]) == (1, 3, "error")


def test_pattern_is_found_anywhere(spark):
    df = spark.createDataFrame([("xxabyy",)], "c string")
    assert checks.pattern_validation(df, {"c": "ab"}).first()["match_ratio"] == 1.0


def test_pattern_on_no_rows_and_on_an_absent_column(spark):
    empty = spark.createDataFrame([], "c string")
    rows = {r["column_name"]: r for r in checks.pattern_validation(empty, {"c": "a", "gone": "a"}).collect()}
    assert (rows["c"]["match_ratio"], rows["c"]["severity"]) == (0.0, "error")
    assert (rows["gone"]["match_ratio"], rows["gone"]["severity"]) == (None, "warning")


def test_ranges(spark):
    df = spark.createDataFrame([(1, 0.5, None), (10, 2.0, None)], "a int, b double, c int")
    ranges = {"a": {"min": 1, "max": 10}, "b": {"max": 1}, "c": {"min": 0}, "gone": {"min": 0}}
    schema = definition(Field("a", "int"), Field("b", "double"), Field("c", "int"), ranges=ranges)
    assert issues(df, schema) == {
        ("b", "range", "error"), ("c", "range", "warning"), ("gone", "range", "warning"),
    }
    rows = {r["column_name"]: r["in_range"] for r in checks.range_validation(df, ranges).collect()}
    assert rows == {"a": True, "b": False, "c": None, "gone": None}


def test_ranges_and_patterns_on_columns_of_another_type(spark):
    df = spark.createDataFrame([("5", 12), ("many", 13)], "s string, n int")
    schema = definition(Field("s", "int"), Field("n", "int"), patterns={"n": "^1[0-9]$"}, ranges={"s": {"min": 6}})
    assert issues(df, schema) == {("s", "type", "error"), ("s", "range", "error")}
    assert checks.range_validation(df, {"s": {"min": 6}}).first()["actual_max"] == 5.0


def test_too_low_and_too_high_are_two_errors(spark):
    df = spark.createDataFrame([(0,), (11,)], "a int")
    row = checks.validate(df, definition(Field("a", "int"), ranges={"a": {"min": 1, "max": 10}})).first()
    assert row["schema_error_count"] == 2
    assert not row["schema_valid"]


def test_errors_of_all_kinds_accumulate(spark):
    df = spark.createDataFrame([("x", 0)], "p string, n int")
    schema = definition(
        Field("p", "string"), Field("n", "int"), Field("q", "string", nullable=False),
        patterns={"p": "^ok$"}, ranges={"n": {"min": 1}},
    )
    assert {i[:2] for i in issues(df, schema) if i[2] == "error"} == {("q", "missing"), ("p", "pattern"), ("n", "range")}


def test_groups_are_validated_apart(spark):
    df = spark.createDataFrame([("a", "ok"), ("b", "no")], "g string, c string")
    schema = definition(Field("g", "string"), Field("c", "string"), patterns={"c": "^ok$"})
    rows = {r["g"]: r["schema_valid"] for r in checks.validate(df, schema, by=["g"]).collect()}
    assert rows == {"a": True, "b": False}


def test_clean_data_has_no_issues(spark):
    df = spark.createDataFrame([("a",)], "c string")
    row = checks.validate(df, definition(Field("c", "string"))).first()
    assert (row["schema_valid"], row["issues"]) == (True, [])


def test_example_schemas_against_the_feeds(spark, sf_dir):
    from assayer.plans import views

    customers = views.customer_src(spark, sf_dir)
    assert checks.validate(customers, CUSTOMER_V1).first()["schema_valid"]
    missing = {i[0] for i in issues(customers, CUSTOMER_V2) if i[1:] == ("missing", "error")}
    assert missing == {"first_name", "last_name"}
    assert not checks.validate(views.sales_src(spark, sf_dir), SALES_V1).first()["schema_valid"]


def profile_of(df, **options):
    return {r["column_name"]: r for r in profile.profile_columns(df, **options).collect()}


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, math.nan, "", None), (None, 2.5, "x", None), (3, None, None, None), (3, 1.5, "x", None)],
        "i int, d double, s string, n string",
    )
    rows = profile_of(df)
    assert (rows["i"]["null_count"], rows["i"]["min_value"], rows["i"]["max_value"]) == (1, 1.0, 3.0)
    assert (rows["d"]["nan_count"], rows["d"]["null_count"]) == (1, 1)
    assert (rows["s"]["empty_count"], rows["s"]["distinct_count"]) == (1, 3)
    assert rows["s"]["cardinality_ratio"] == pytest.approx(1.0)
    assert (rows["n"]["completeness"], rows["n"]["distinct_count"], rows["n"]["cardinality_ratio"]) == (0.0, 1, 0.0)
    assert rows["i"]["distinct_count"] is None


def test_profile_of_decimals_and_no_rows(spark):
    df = spark.createDataFrame([("1.50",)], "s string").select(F.col("s").cast("decimal(10,2)").alias("d"))
    assert profile_of(df)["d"]["min_value"] == 1.5
    rows = profile_of(spark.createDataFrame([], "s string, i int"))
    assert (rows["s"]["record_count"], rows["s"]["completeness"]) == (0, 0.0)


def test_profile_with_a_sketch_or_without_distincts(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("s"), F.lit(None).cast("string").alias("n"))
    assert profile_of(df, distinct="approx")["s"]["distinct_count"] == 10
    assert profile_of(df, distinct="approx")["n"]["distinct_count"] == 1
    assert profile_of(df, distinct="none")["s"]["distinct_count"] is None


def test_hot_value_and_many_values(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("s"))
    assert profile.distinct_counts(df, ["s"]).first()["distinct_count"] == 2001


def test_preview(spark):
    info, rows = profile.preview(spark.range(20), 5)
    row = info.first()
    assert (row["row_count"], row["column_count"], row["schema_text"]) == (20, 1, "struct<id:bigint>")
    assert rows.count() == 5
