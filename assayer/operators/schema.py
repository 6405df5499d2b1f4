"""Declared schemas: fields, constraints, type names, and which types may stand for which."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and the Spark types they stand for.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "short": T.ShortType(),
    "smallint": T.ShortType(),
    "byte": T.ByteType(),
    "tinyint": T.ByteType(),
    "binary": T.BinaryType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# A declared type on the left accepts data of the types on the right.
COMPATIBLE_TYPES: dict[str, tuple[str, ...]] = {
    "int": ("int", "integer", "bigint", "smallint", "tinyint"),
    "integer": ("int", "integer", "bigint", "smallint", "tinyint"),
    "long": ("bigint", "int", "smallint", "tinyint"),
    "short": ("smallint", "tinyint"),
    "byte": ("tinyint",),
    "bool": ("boolean",),
    "float": ("float", "double", "decimal"),
    "double": ("float", "double", "decimal"),
    "string": ("string", "varchar", "char"),
    "timestamp": ("timestamp", "timestamp_ntz"),
}

DECIMAL = re.compile(r"decimal\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


@dataclass(frozen=True)
class Field:
    """One declared column."""

    name: str
    type: str
    nullable: bool = True
    default: Any = None
    previous_name: str | None = None
    description: str | None = None
    fields: tuple[Field, ...] = ()
    element_type: str | None = None


@dataclass(frozen=True)
class SchemaDefinition:
    """Fields and value constraints of one version of a schema. ``version`` 0 means unversioned."""

    name: str
    version: int
    fields: tuple[Field, ...]
    patterns: Mapping[str, str] = field(default_factory=dict)
    ranges: Mapping[str, Mapping[str, float]] = field(default_factory=dict)

    @property
    def by_name(self) -> dict[str, Field]:
        return {f.name: f for f in self.fields}


def version_number(version: str | int | None) -> int:
    """``v10`` is 10, so that it comes after ``v9``; no version is 0.

    A version is one whole number, with any letters about it. Several numbers (``v1.10``) are refused, as they have no
    place in that order; ``version_column`` keeps the same rule.
    """
    if version is None or version == "":
        return 0
    numbers = re.findall(r"[0-9]+", str(version))
    if not numbers:
        raise ValueError(f"no number in schema version {version!r}")
    if len(numbers) > 1:
        raise ValueError(f"several numbers in schema version {version!r}")
    return int(numbers[0])


def version_column(version: Column) -> Column:
    """``version_number`` of a column, from numbers or texts; a text that is no version fails the job."""
    text = F.coalesce(version.cast("string"), F.lit(""))
    numbers = F.regexp_extract_all(text, F.lit("([0-9]+)"))
    problem = F.when(F.size(numbers) == 0, "no number").otherwise("several numbers")
    refused = F.raise_error(F.format_string("%s in schema version '%s'", problem, text)).cast("int")
    return F.when(text == "", 0).when(F.size(numbers) == 1, F.element_at(numbers, 1).cast("int")).otherwise(refused)


def spark_type(type_name: str, fields: tuple[Field, ...] = (), element_type: str | None = None) -> T.DataType:
    """The Spark type of a declared type name."""
    name = type_name.strip().lower()
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    if name == "struct" and fields:
        return to_struct(fields)
    if name == "array" and element_type:
        return T.ArrayType(spark_type(element_type))
    if name.startswith("decimal"):
        parameters = DECIMAL.fullmatch(name)
        if not parameters:
            return T.DecimalType(10, 2)
        return T.DecimalType(int(parameters[1]), int(parameters[2] or 0))
    if "<" in name:
        return T.DataType.fromDDL(type_name)
    raise ValueError(f"unsupported type: {type_name}")


def type_name(data_type: T.DataType) -> str:
    """The declared name of a Spark type; ``spark_type`` reads it back unchanged."""
    return data_type.simpleString()


def to_struct(definition: SchemaDefinition | tuple[Field, ...]) -> T.StructType:
    """The Spark schema of a definition."""
    fields = definition.fields if isinstance(definition, SchemaDefinition) else definition
    for f in fields:
        if not f.name or not f.type:
            raise ValueError(f"a field needs a name and a type: {f}")
    return T.StructType(
        [T.StructField(f.name, spark_type(f.type, f.fields, f.element_type), f.nullable) for f in fields]
    )


def declared_type(f: Field) -> str:
    """The type of a field as data of that type would report it, with declared aliases kept."""
    if f.fields or f.element_type:
        return spark_type(f.type, f.fields, f.element_type).simpleString()
    return f.type.strip().lower()


def compatible(expected: Column, actual: Column) -> Column:
    """Whether data of type ``actual`` satisfies the declared type ``expected``, on columns of type names.

    Equal after dropping punctuation, or of the same family; any decimal satisfies any decimal.
    """

    def bare(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")

    def base(c: Column) -> Column:
        return F.trim(F.substring_index(F.lower(c), "(", 1))

    matches = (bare(expected) == bare(actual)) | (base(expected).startswith("decimal") & base(actual).startswith("decimal"))
    for name, accepted in COMPATIBLE_TYPES.items():
        matches = matches | ((base(expected) == name) & base(actual).isin(*accepted))
    return matches


def is_compatible(expected: str, actual: str) -> bool:
    """The rule of ``compatible`` for two type names known on the driver."""

    def bare(name: str) -> str:
        return re.sub("[^a-z0-9]", "", name.lower())

    def base(name: str) -> str:
        return name.lower().split("(")[0].strip()

    if bare(expected) == bare(actual) or base(actual) in COMPATIBLE_TYPES.get(base(expected), ()):
        return True
    return base(expected).startswith("decimal") and base(actual).startswith("decimal")


def definition_from_frame(df: DataFrame, name: str, version: int = 0) -> SchemaDefinition:
    """The definition that a dataset without one gets: its own fields, no constraints."""
    return SchemaDefinition(
        name, version, tuple(Field(f.name, type_name(f.dataType), f.nullable) for f in df.schema.fields)
    )


def definition_from_json(text: str, name: str | None = None, version: str | int | None = None) -> SchemaDefinition:
    """Read one schema version in its landing form, a JSON object with ``fields`` and constraints."""
    body = json.loads(text)

    def read_field(raw: Mapping[str, Any]) -> Field:
        if not raw.get("name") or not raw.get("type"):
            raise ValueError(f"a field needs a name and a type: {raw}")
        return Field(
            name=raw["name"],
            type=raw["type"],
            nullable=raw.get("nullable", True),
            default=raw.get("default"),
            previous_name=raw.get("previous_name"),
            description=raw.get("description"),
            fields=tuple(read_field(f) for f in raw.get("fields", ())),
            element_type=raw.get("element_type"),
        )

    return SchemaDefinition(
        name=name or body["name"],
        version=version_number(version if version is not None else body.get("version")),
        fields=tuple(read_field(f) for f in body.get("fields", ())),
        patterns=dict(body.get("pattern_constraints", {})),
        ranges={c: dict(r) for c, r in body.get("range_constraints", {}).items()},
    )


def definition_to_json(definition: SchemaDefinition) -> str:
    """The landing form of one schema version."""

    def field_body(f: Field) -> dict[str, Any]:
        body: dict[str, Any] = {"name": f.name, "type": f.type, "nullable": f.nullable}
        for key in ("default", "previous_name", "description", "element_type"):
            if getattr(f, key) is not None:
                body[key] = getattr(f, key)
        if f.fields:
            body["fields"] = [field_body(child) for child in f.fields]
        return body

    return json.dumps(
        {
            "name": definition.name,
            "version": definition.version,
            "fields": [field_body(f) for f in definition.fields],
            "pattern_constraints": dict(definition.patterns),
            "range_constraints": {c: dict(r) for c, r in definition.ranges.items()},
        }
    )


def evolve_definition(current: SchemaDefinition, changes: Mapping[str, Any], new_version: str | int) -> SchemaDefinition:
    """A new version with fields added, removed and modified and constraints set or (with None) dropped."""
    fields = list(current.fields)
    names = {f.name for f in fields}
    for added in changes.get("add_fields", ()):
        added = added if isinstance(added, Field) else Field(**added)
        if added.name not in names:
            fields.append(added)
            names.add(added.name)
    removed = set(changes.get("remove_fields", ()))
    modified = changes.get("modify_fields", {})
    fields = [replace(f, **modified.get(f.name, {})) for f in fields if f.name not in removed]

    def edited(constraints: Mapping[str, Any], edits: Mapping[str, Any]) -> dict[str, Any]:
        merged = {**constraints, **edits}
        return {column: value for column, value in merged.items() if value is not None}

    return replace(
        current,
        version=version_number(new_version),
        fields=tuple(fields),
        patterns=edited(current.patterns, changes.get("pattern_constraints", {})),
        ranges=edited(current.ranges, changes.get("range_constraints", {})),
    )


def apply_evolution(df: DataFrame, source: SchemaDefinition, target: SchemaDefinition, rescued: str | None = None) -> DataFrame:
    """Bring data from one schema version to another in a single projection.

    Removed columns go, renamed ones keep their data, new ones get their default or null of the
    declared type, and columns whose type changed are cast; a cell that does not fit becomes null.

    With ``rescued``, and if some column is cast, a column of that name keeps the cells that did not fit: a map from the
    new column's name to the old value as text (JSON for nested values, hexadecimal for bytes), null where all cells fit. Which
    columns are cast stands in the column's metadata; ``rescue_counts`` reads it. A column of that name in the data is an error.
    """
    old, new = source.by_name, target.by_name
    renamed = {
        f.previous_name: f.name
        for f in target.fields
        if f.previous_name and f.previous_name in df.columns and f.name not in df.columns
    }
    kept = [c for c in df.columns if c not in old or c in new or c in renamed]
    selected: list[Column] = []
    unfit: dict[str, Column] = {}
    for column in kept:
        name = renamed.get(column, column)
        value = F.col(f"`{column}`")
        if name in new:
            wanted = spark_type(new[name].type, new[name].fields, new[name].element_type)
            if not is_compatible(declared_type(new[name]), df.schema[column].dataType.simpleString()):
                unfit[name] = F.when(value.isNotNull() & value.try_cast(wanted).isNull(), _as_text(value, df.schema[column].dataType))
                value = value.try_cast(wanted)
        selected.append(value.alias(name))
    present = {renamed.get(c, c) for c in kept}
    for f in target.fields:
        if f.name not in present and f.name not in old:
            selected.append(F.lit(f.default).cast(spark_type(f.type, f.fields, f.element_type)).alias(f.name))
    if rescued is None or not unfit:
        return df.select(*selected)
    if rescued in present or rescued in new:
        raise ValueError(f"there is a column {rescued!r} already")
    cells = F.filter(F.array(*(F.struct(F.lit(n).alias("key"), text.alias("value")) for n, text in unfit.items())), lambda c: c["value"].isNotNull())
    kept_cells = F.when(F.size(cells) > 0, F.map_from_entries(cells))
    return df.select(*selected, kept_cells.alias(rescued, metadata={RESCUED_COLUMNS: list(unfit)}))


RESCUED_COLUMNS = "rescued_columns"


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")


def rescue_counts(df: DataFrame, rescued: str) -> dict[str, Column]:
    """For each column that was cast, the count of the cells that did not fit, as an aggregate of the scan that counts all else."""
    if rescued not in df.columns:
        return {}
    columns = df.schema[rescued].metadata.get(RESCUED_COLUMNS, [])
    return {c: F.count_if(F.coalesce(F.map_contains_key(F.col(rescued), c), F.lit(False))) for c in columns}
