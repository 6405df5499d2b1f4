"""The schema registry as tables, and schema comparisons as joins.

Field rows are ``(schema_name, version, position, name, type, nullable, default, previous_name)``.
A registry of a few schemas and one of millions of them are compared the same way: full outer
joins on (schema, field), whose sides hold one row per key and so cannot be skewed by a key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators.latest import latest_per_key
from assayer.operators.schema import (
    Field,
    SchemaDefinition,
    compatible,
    definition_from_json,
    definition_to_json,
    evolve_definition,
    version_column,
    version_number,
)
from assayer.session import claim_text, remove_path

REGISTRY_SCHEMA = "schema_name string, version int, definition string, registered_at timestamp"
EVENT_SCHEMA = (
    "event_id string, event_type string, schema_name string, version int, "
    "request_id string, changes string, timestamp timestamp"
)
FIELD_TYPE = "struct<name:string,type:string,nullable:boolean,default:string,previous_name:string>"


class VersionTaken(ValueError):
    """Another writer has registered, or is registering, another definition under this version of the schema."""


def claim_version(spark: SparkSession, table_path: str, definition: SchemaDefinition) -> None:
    """Claim a version of a schema for a definition, or raise ``VersionTaken``.

    The claim is a file named by schema and number that is created once and holds the definition, so of two writers of one
    number one wins. The same definition may claim again: a writer that died between claim and registration is simply
    run again. The unversioned definition (0) claims number 1. A claim whose writer died while creating it is empty and holds its
    number until ``release_version``.
    """
    text = definition_to_json(replace(definition, version=max(definition.version, 1)))
    held = claim_text(spark, _claim_file(table_path, definition.name, definition.version), text)
    if held != text:
        raise VersionTaken(f"version {max(definition.version, 1)} of schema {definition.name!r} is taken by another definition")


def release_version(spark: SparkSession, table_path: str, name: str, version: str | int) -> bool:
    """Give up a claim that no registered version stands for; whether there was one."""
    if _registered(spark, table_path, name, version_number(version)):
        raise ValueError(f"version {version!r} of schema {name!r} is registered")
    return remove_path(spark, _claim_file(table_path, name, version_number(version)))


def _claim_file(table_path: str, name: str, version: int) -> str:
    return f"{table_path.rstrip('/')}/_claims/{quote(name, safe='')}/v{max(version, 1)}"  # readers skip names that begin with _


def _registered(spark: SparkSession, table_path: str, name: str, version: int) -> list[str]:
    """The definitions that were registered under a number, 0 being 1, newest last."""
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).parquet(table_path)
    except AnalysisException:  # nothing was registered yet
        return []
    found = rows.where((F.col("schema_name") == name) & (F.greatest("version", F.lit(1)) == max(version, 1)))
    return [r["definition"] for r in found.orderBy("registered_at").collect()]


def add_version(spark: SparkSession, table_path: str, definition: SchemaDefinition) -> None:
    """Register a version that must be new: claimed first, so that no two writers register it with different definitions.

    Registering the same definition again adds nothing. A number that was registered without a claim is taken, too.
    """
    claim_version(spark, table_path, definition)
    same = definition_to_json(replace(definition, version=0))
    there = _registered(spark, table_path, definition.name, definition.version)
    if not there:
        register_versions(spark, table_path, [definition])
    elif definition_to_json(definition_from_json(there[-1], definition.name, 0)) != same:
        raise VersionTaken(f"version {max(definition.version, 1)} of schema {definition.name!r} is registered with another definition")


def register_version(spark: SparkSession, table_path: str, definition: SchemaDefinition) -> None:
    """Append one version without a claim: a registration that replaces an earlier one of the same number.

    The first one may be unversioned (0); it counts as 1 once others follow.
    """
    register_versions(spark, table_path, [definition])


def register_versions(spark: SparkSession, table_path: str, definitions: list[SchemaDefinition]) -> None:
    """Append versions of some schemas in one write."""
    now = datetime.now(timezone.utc)
    rows = [(d.name, d.version, definition_to_json(d), now) for d in definitions]
    spark.createDataFrame(rows, REGISTRY_SCHEMA).write.mode("append").partitionBy("schema_name").parquet(table_path)


def read_registry(spark: SparkSession, table_path: str) -> DataFrame:
    """The latest registration of every schema version."""
    rows = spark.read.schema(REGISTRY_SCHEMA).parquet(table_path)
    numbered = rows.withColumn("version", F.when(F.col("version") == 0, 1).otherwise(F.col("version")))
    return latest_per_key(numbered, ["schema_name", "version"], ["registered_at"])


def has_schema(spark: SparkSession, table_path: str, name: str) -> bool:
    """Whether any version of a schema is registered."""
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).parquet(table_path)
    except AnalysisException:  # nothing was registered yet
        return False
    return not rows.where(F.col("schema_name") == name).isEmpty()


def get_version(spark: SparkSession, table_path: str, name: str, version: str | int = "latest") -> SchemaDefinition:
    """One schema version; ``latest`` is the greatest number. Reads only this schema's partition."""
    versions = read_registry(spark, table_path).where(F.col("schema_name") == name)
    if version != "latest":
        versions = versions.where(F.col("version") == version_number(version))
    found = versions.orderBy(F.desc("version")).limit(1).collect()
    if not found:
        raise ValueError(f"no schema {name!r} in version {version!r}")
    return definition_from_json(found[0]["definition"], name, found[0]["version"])


def evolve(
    spark: SparkSession,
    table_path: str,
    name: str,
    changes: dict,
    new_version: str | int,
    events_path: str | None = None,
) -> SchemaDefinition:
    """Apply changes to the latest version, register the result, and note a ``schema_evolved`` event.

    The version is claimed (``add_version``): of two writers that evolve to one number with different changes, one gets ``VersionTaken``.
    """
    latest = get_version(spark, table_path, name)
    evolved = evolve_definition(latest, changes, new_version)
    if evolved.version <= latest.version:  # an unversioned definition counts as version 1
        raise ValueError(f"schema {name!r} is at version {latest.version} already")
    add_version(spark, table_path, evolved)
    if events_path:
        append_event(spark, events_path, "schema_evolved", name, evolved.version, json.dumps(changes, default=str))
    return evolved


def field_rows(registry: DataFrame) -> DataFrame:
    """Field rows of every registered version, read out of the landing form."""
    fields = F.from_json(F.get_json_object("definition", "$.fields"), f"array<{FIELD_TYPE}>")
    return registry.select("schema_name", "version", F.posexplode(fields).alias("position", "f")).select(
        "schema_name", "version", "position", "f.*"
    )


def constraint_rows(registry: DataFrame) -> DataFrame:
    """Pattern and range constraints of every registered version."""
    patterns = F.from_json(F.get_json_object("definition", "$.pattern_constraints"), "map<string,string>")
    ranges = F.from_json(
        F.get_json_object("definition", "$.range_constraints"), "map<string,struct<min:double,max:double>>"
    )
    pattern_rows = registry.select("schema_name", "version", F.explode(patterns).alias("column_name", "pattern"))
    range_rows = registry.select("schema_name", "version", F.explode(ranges).alias("column_name", "r"))
    return pattern_rows.withColumn("kind", F.lit("pattern")).unionByName(
        range_rows.select(
            "schema_name", "version", "column_name", F.col("r.min").alias("min"), F.col("r.max").alias("max"),
            F.lit("range").alias("kind"),
        ),
        allowMissingColumns=True,
    )


def definition_rows(spark: SparkSession, definition: SchemaDefinition) -> DataFrame:
    """Field rows of one definition."""
    rows = [
        (definition.name, definition.version, i, f.name, f.type, f.nullable,
         None if f.default is None else str(f.default), f.previous_name)
        for i, f in enumerate(definition.fields)
    ]
    return spark.createDataFrame(
        rows,
        "schema_name string, version int, position int, name string, type string, "
        "nullable boolean, default string, previous_name string",
    )


def latest_versions(versions: DataFrame, schema: str = "schema_name", version: str = "version") -> DataFrame:
    """Greatest version number per schema, from numbers or from texts such as ``v10``."""
    return versions.groupBy(schema).agg(F.max(version_column(F.col(version))).alias("latest"))


def at_version(fields: DataFrame, versions: DataFrame, version_column: str) -> DataFrame:
    """Field rows of one chosen version per schema."""
    chosen = versions.select("schema_name", F.col(version_column).alias("version"))
    return fields.join(chosen, ["schema_name", "version"], "left_semi")


def both_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    l = left.select(*keys, F.struct(*[c for c in left.columns if c not in keys]).alias("l"))
    r = right.select(*keys, F.struct(*[c for c in right.columns if c not in keys]).alias("r"))
    return l.join(r, list(keys), "full_outer")


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """State of every field of expected (with ``nullable``) and actual, by schema and name.

    ``missing_required``, ``missing_optional``, ``extra``, ``type`` or ``ok``.
    """
    both = both_sides(
        expected.select("schema_name", "name", "type", "nullable"),
        actual.select("schema_name", "name", "type"),
        ["schema_name", "name"],
    )
    state = (
        F.when(F.col("r").isNull() & ~F.col("l.nullable"), "missing_required")
        .when(F.col("r").isNull(), "missing_optional")
        .when(F.col("l").isNull(), "extra")
        .when(~compatible(F.col("l.type"), F.col("r.type")), "type")
        .otherwise("ok")
    )
    return both.select("schema_name", F.col("name").alias("column_name"), state.alias("state"))


def field_issues(diff: DataFrame) -> DataFrame:
    """Issue rows of a schema diff, with the severity of each state."""
    return diff.where(F.col("state") != "ok").select(
        "schema_name",
        "column_name",
        F.when(F.col("state").startswith("missing"), "missing").otherwise(F.col("state")).alias("issue_type"),
        F.when(F.col("state").isin("missing_required", "type"), "error").otherwise("warning").alias("severity"),
    )


def version_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per schema and field: add, remove, modify or keep, from one version to another."""
    both = both_sides(
        source.select("schema_name", "name", "type", "nullable"),
        target.select("schema_name", "name", "type", "nullable"),
        ["schema_name", "name"],
    )
    change = (
        F.when(F.col("l").isNull(), "add")
        .when(F.col("r").isNull(), "remove")
        .when((F.col("l.type") != F.col("r.type")) | (F.col("l.nullable") != F.col("r.nullable")), "modify")
        .otherwise("keep")
    )
    return both.select("schema_name", F.col("name").alias("field"), change.alias("change"))


def infer_changes(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Changes that would make the declared fields fit the observed ones, in the form ``changes_of`` reads."""
    both = both_sides(
        expected.select("schema_name", "name", "type", "nullable"),
        actual.select("schema_name", "name", "type", "nullable"),
        ["schema_name", "name"],
    )
    change = (
        F.when(F.col("l").isNull(), "add_field")
        .when(F.col("r").isNull(), "remove_field")
        .when(~compatible(F.col("l.type"), F.col("r.type")), "modify_field")
    )
    return both.select(
        "schema_name",
        F.col("name").alias("field"),
        change.alias("change"),
        F.col("l.type").alias("old_type"),
        F.col("r.type").alias("new_type"),
        F.col("r.nullable").alias("nullable"),
    ).where(F.col("change").isNotNull())


def evolve_fields(fields: DataFrame, changes: DataFrame) -> DataFrame:
    """Field rows after change rows: removed ones go, modified ones take the new type, new ones are appended."""
    both = both_sides(
        fields.select("schema_name", "name", "type", "nullable"),
        changes.select("schema_name", F.col("field").alias("name"), "change", "new_type", F.col("nullable").alias("may_be_null")),
        ["schema_name", "name"],
    )
    kept = both.where(F.coalesce(F.col("r.change") != "remove_field", F.lit(True)))
    changed = F.col("l").isNull() | F.coalesce(F.col("r.change") == "modify_field", F.lit(False))
    return kept.select(
        "schema_name",
        "name",
        F.when(changed, F.col("r.new_type")).otherwise(F.col("l.type")).alias("type"),
        F.when(changed, F.col("r.may_be_null")).otherwise(F.col("l.nullable")).alias("nullable"),
    )


def changes_of(change_rows: DataFrame, schema_name: str) -> dict:
    """Change rows of one schema as the argument of ``evolve``; as many rows as the schema has fields."""
    rows = change_rows.where(F.col("schema_name") == schema_name).collect()
    return {
        "add_fields": [Field(r["field"], r["new_type"], r["nullable"]) for r in rows if r["change"] == "add_field"],
        "remove_fields": [r["field"] for r in rows if r["change"] == "remove_field"],
        "modify_fields": {
            r["field"]: {"type": r["new_type"], "nullable": r["nullable"]} for r in rows if r["change"] == "modify_field"
        },
    }


def version_status(in_use: DataFrame, latest: DataFrame, current: str = "current") -> DataFrame:
    """Whether each schema in use is at its newest registered version."""
    state = F.when(F.col(current) >= F.col("latest"), "current").otherwise("outdated")
    return in_use.join(latest, "schema_name").select("schema_name", current, "latest", state.alias("version_state"))


def append_event(
    spark: SparkSession,
    events_path: str,
    event_type: str,
    schema_name: str,
    version: int | None = None,
    changes: str | None = None,
    request_id: str | None = None,
    moment: datetime | None = None,
) -> None:
    """Append one row to the schema event table."""
    append_events(spark, events_path, [(event_type, schema_name, version, changes, request_id)], moment)


def append_events(spark: SparkSession, events_path: str, events: list[tuple], moment: datetime | None = None) -> None:
    """Append (type, schema name, version, changes, request id) rows to the schema event table in one write."""
    stamp = moment or datetime.now(timezone.utc)
    rows = [(str(uuid.uuid4()), kind, name, version, request_id, changes, stamp) for kind, name, version, changes, request_id in events]
    spark.createDataFrame(rows, EVENT_SCHEMA).write.mode("append").parquet(events_path)


def request_evolution(change_rows: DataFrame, schema_name: str, events_path: str) -> str:
    """Append an ``evolution_requested`` event with the inferred changes of a schema; gives the request's id."""
    request_id = str(uuid.uuid4())
    rows = change_rows.where(F.col("schema_name") == schema_name).orderBy("field").toJSON().collect()
    append_event(
        change_rows.sparkSession, events_path, "evolution_requested", schema_name,
        changes="[" + ",".join(rows) + "]", request_id=request_id,
    )
    return request_id


def frame_field_rows(df: DataFrame, schema_name: str) -> DataFrame:
    """The fields of a frame as field rows, without a job."""
    rows = [(schema_name, f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "schema_name string, name string, type string, nullable boolean")

