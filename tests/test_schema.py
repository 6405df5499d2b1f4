from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators import registry
from assayer.operators.schema import (
    Field,
    SchemaDefinition,
    apply_evolution,
    compatible,
    definition_from_frame,
    definition_from_json,
    definition_to_json,
    evolve_definition,
    is_compatible,
    spark_type,
    to_struct,
    type_name,
    version_column,
    version_number,
)
from assayer.plans.definitions import CUSTOMER_V1, CUSTOMER_V2, SALES_V1


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("string", T.StringType()), ("Integer", T.IntegerType()), ("int", T.IntegerType()), ("float", T.FloatType()),
        ("double", T.DoubleType()), ("bool", T.BooleanType()), ("boolean", T.BooleanType()), ("timestamp", T.TimestampType()),
        ("date", T.DateType()), ("decimal(12,4)", T.DecimalType(12, 4)), ("decimal(12)", T.DecimalType(12, 0)),
        ("decimal", T.DecimalType(10, 2)), ("decimal(x,y)", T.DecimalType(10, 2)), ("long", T.LongType()),
        ("binary", T.BinaryType()), ("timestamp_ntz", T.TimestampNTZType()), ("map<string,int>", T.MapType(T.StringType(), T.IntegerType())),
    ],
)
def test_type_names(spark, name, expected):
    assert spark_type(name) == expected


def test_nested_types():
    assert spark_type("array", element_type="int") == T.ArrayType(T.IntegerType())
    assert spark_type("struct", (Field("a", "int"),)) == T.StructType([T.StructField("a", T.IntegerType())])


@pytest.mark.parametrize("name", ["interval", "varchar", "array", "struct", ""])
def test_unknown_types(name):
    with pytest.raises(ValueError, match="unsupported"):
        spark_type(name)


def test_type_names_round_trip(spark):
    schema = T.StructType.fromDDL(
        "a tinyint, b smallint, c int, d bigint, e float, f double, g decimal(9,3), h string, i binary, j boolean, k date, "
        "l timestamp, m timestamp_ntz, n array<array<int>>, o map<string,double>, p struct<x:int,y:array<string>>"
    )
    for field in schema:
        assert spark_type(type_name(field.dataType)) == field.dataType


def test_struct_needs_names_and_types():
    assert to_struct(SALES_V1)["unit_price"].dataType == T.DecimalType(10, 2)
    assert not to_struct(SALES_V1)["quantity"].nullable
    with pytest.raises(ValueError, match="needs a name"):
        to_struct((Field("", "int"),))


CASES = [
    ("integer", "bigint", True), ("int", "tinyint", True), ("integer", "double", False), ("double", "decimal(10,2)", True),
    ("float", "double", True), ("double", "int", False), ("string", "varchar(10)", True), ("string", "int", False),
    ("decimal(10,2)", "decimal(38,0)", True), ("decimal(10,2)", "double", False), ("timestamp", "string", False),
    ("timestamp", "timestamp_ntz", True), ("bool", "boolean", True), ("array<int>", "array<int>", True),
    ("array<int>", "array<string>", False), ("bigint", "int", False), ("long", "bigint", True), ("date", "date", True),
]


@pytest.mark.parametrize(("expected", "actual", "fits"), CASES)
def test_compatible_types(expected, actual, fits):
    assert is_compatible(expected, actual) is fits


def test_compatible_types_on_columns(spark):
    df = spark.createDataFrame(CASES, "expected string, actual string, fits boolean")
    assert df.where(compatible(F.col("expected"), F.col("actual")) != F.col("fits")).count() == 0


def test_versions_are_numbers():
    assert version_number("v10") > version_number("v9")
    assert version_number(None) == 0
    with pytest.raises(ValueError, match="no number"):
        version_number("newest")
    with pytest.raises(ValueError, match="several numbers"):
        version_number("v1.10")


def test_version_columns_keep_the_rule_of_version_numbers(spark):
    texts = ["v10", "9", "", None, "schema-v007"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.n for r in df.orderBy("i").select(version_column(F.col("t")).alias("n")).collect()] == [version_number(t) for t in texts]
    for text, message in (("v1.10", "several numbers"), ("newest", "no number")):
        with pytest.raises(Exception, match=message):
            spark.createDataFrame([(text,)], "t string").select(version_column(F.col("t"))).collect()


def test_landing_form_round_trips():
    for d in (CUSTOMER_V1, CUSTOMER_V2, SALES_V1):
        assert definition_from_json(definition_to_json(d)) == d
    with pytest.raises(ValueError, match="needs a name"):
        definition_from_json('{"name": "x", "fields": [{"name": "a"}]}')


def test_evolve_definition():
    changed = evolve_definition(
        CUSTOMER_V1,
        {
            "add_fields": [{"name": "age", "type": "int"}, {"name": "email", "type": "int"}],
            "remove_fields": ["address"],
            "modify_fields": {"phone": {"name": "mobile", "previous_name": "phone", "nullable": False}},
            "pattern_constraints": {"phone": None, "name": "^[A-Z]"},
            "range_constraints": {"age": {"min": 0}},
        },
        "v3",
    )
    assert [f.name for f in changed.fields] == ["customer_id", "name", "email", "mobile", "created_at", "age"]
    assert changed.by_name["email"].type == "string"
    assert not changed.by_name["mobile"].nullable
    assert set(changed.patterns) == {"email", "customer_id", "name"}
    assert changed.ranges == {"age": {"min": 0}}
    assert changed.version == 3
    assert len(CUSTOMER_V1.fields) == 6


def test_evolved_data_has_the_new_columns_and_defaults(spark):
    df = spark.createDataFrame([("CUST-000001", "Ann", "a@b.c", None, "x", dt.datetime(2024, 1, 1))], to_struct(CUSTOMER_V1))
    evolved = apply_evolution(df, CUSTOMER_V1, CUSTOMER_V2)
    assert set(evolved.columns) == {f.name for f in CUSTOMER_V2.fields}
    row = evolved.first()
    assert (row["country"], row["customer_type"], row["city"]) == ("USA", "regular", None)
    assert dict(evolved.dtypes)["updated_at"] == "timestamp"


def test_rename_keeps_data_and_casts_to_the_new_type(spark):
    old = SchemaDefinition("s", 1, (Field("a", "string"), Field("n", "string")))
    new = SchemaDefinition("s", 2, (Field("b", "string", previous_name="a"), Field("n", "int")))
    df = spark.createDataFrame([("x", "12", 1), ("y", "twelve", 2)], "a string, n string, other int")
    rows = apply_evolution(df, old, new).orderBy("other").collect()
    assert [r.asDict() for r in rows] == [{"b": "x", "n": 12, "other": 1}, {"b": "y", "n": None, "other": 2}]


def test_rename_does_not_overwrite_an_existing_column(spark):
    old = SchemaDefinition("s", 1, (Field("a", "string"), Field("b", "string")))
    new = SchemaDefinition("s", 2, (Field("b", "string", previous_name="a"),))
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    assert [r.asDict() for r in apply_evolution(df, old, new).collect()] == [{"b": "y"}]


def test_definition_from_frame(spark):
    d = definition_from_frame(spark.createDataFrame([(1, [1])], "a bigint, b array<int>"), "s")
    assert [(f.name, f.type) for f in d.fields] == [("a", "bigint"), ("b", "array<int>")]
    assert to_struct(d)["b"].dataType == T.ArrayType(T.IntegerType())


def test_registry_tables(spark, tmp_path):
    path = str(tmp_path / "registry")
    first = SchemaDefinition("s", 0, (Field("a", "int"),), {"a": "1"}, {"a": {"min": 1.0}})
    registry.register_version(spark, path, first)
    assert registry.get_version(spark, path, "s").version == 1
    for version in (2, 10, 9):
        registry.register_version(spark, path, SchemaDefinition("s", version, (Field("a", "int"), Field(f"f{version}", "string"))))
    registry.register_version(spark, path, SchemaDefinition("t", 1, (Field("z", "int"),)))
    assert registry.get_version(spark, path, "s").by_name.keys() == {"a", "f10"}
    assert registry.get_version(spark, path, "s", "v1").fields == (Field("a", "int"),)
    assert registry.get_version(spark, path, "s", "v2").by_name.keys() == {"a", "f2"}
    for name, version in (("s", "v3"), ("u", "latest")):
        with pytest.raises(ValueError, match="no schema"):
            registry.get_version(spark, path, name, version)
    registered = registry.read_registry(spark, path)
    assert registry.field_rows(registered).count() == 8
    assert {(r["kind"], r["pattern"], r["min"]) for r in registry.constraint_rows(registered).collect()} == {
        ("pattern", "1", None), ("range", None, 1.0),
    }
    registry.register_version(spark, path, SchemaDefinition("s", 2, (Field("again", "int"),)))
    assert registry.get_version(spark, path, "s", 2).by_name.keys() == {"again"}


def test_inferred_changes_can_be_applied(spark, tmp_path):
    path, events = str(tmp_path / "registry"), str(tmp_path / "events")
    registry.register_version(spark, path, CUSTOMER_V1)
    df = spark.createDataFrame([], "customer_id string, name int, email string, phone string, created_at timestamp, age int")
    changes = registry.infer_changes(
        registry.definition_rows(spark, CUSTOMER_V1), registry.frame_field_rows(df, "customer_data")
    )
    found = {(r["field"], r["change"]) for r in changes.collect()}
    assert found == {("address", "remove_field"), ("age", "add_field"), ("name", "modify_field")}
    request = registry.request_evolution(changes, "customer_data", events)
    evolved = registry.evolve(spark, path, "customer_data", registry.changes_of(changes, "customer_data"), "v2", events)
    assert {f.name: f.type for f in evolved.fields}["name"] == "int"
    assert set(evolved.by_name) == set(df.columns)
    assert registry.get_version(spark, path, "customer_data").version == 2
    rows = {r["event_type"]: r for r in spark.read.parquet(events).collect()}
    assert rows["evolution_requested"]["request_id"] == request
    assert '"field":"age"' in rows["evolution_requested"]["changes"]
    assert rows["schema_evolved"]["version"] == 2


def test_version_status_and_latest(spark):
    versions = spark.createDataFrame([("a", "v9"), ("a", "v10"), ("b", "v1")], "schema_name string, version string")
    latest = registry.latest_versions(versions)
    assert {r["schema_name"]: r["latest"] for r in latest.collect()} == {"a": 10, "b": 1}
    used = spark.createDataFrame([("a", 9), ("b", 1)], "schema_name string, current int")
    assert {r["schema_name"]: r["version_state"] for r in registry.version_status(used, latest).collect()} == {
        "a": "outdated", "b": "current",
    }
