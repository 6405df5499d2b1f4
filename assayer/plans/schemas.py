"""Queries on schemas: validation, comparison of versions, evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators import checks, monitor, profile, registry
from assayer.operators.schema import Field, SchemaDefinition, apply_evolution, compatible
from assayer.plans import views
from assayer.plans.batch import Run, evolve_if_needed, grade_source
from assayer.plans.catalog import register
from assayer.plans.definitions import CUSTOMER_ID, CUSTOMER_V1, CUSTOMER_V2, EMAIL, PHONE
from assayer.plans.views import (
    CUSTOMER_SRC,
    DECLARED_FIELDS,
    LATEST_VERSIONS,
    OBSERVED_FIELDS,
    VERSIONS_IN_USE,
)
from assayer.session import cut_lineage, fresh_path

# The declared fields of each schema's newest version, and the comparison of type names, as SQL.
LATEST_FIELDS = f"""(SELECT d.schema_name, d.name, d.type, d.nullable FROM {DECLARED_FIELDS.replace(') declared_fields', ') d')}
 JOIN {LATEST_VERSIONS} ON latest_versions.schema_name = d.schema_name AND d.version = latest_versions.latest)"""


def _compatible_sql(expected: str, actual: str) -> str:
    return f"""({expected} = {actual} OR ({expected} = 'integer' AND {actual} IN ('int','integer','bigint','smallint','tinyint'))
 OR ({expected} IN ('float','double') AND ({actual} IN ('float','double') OR {actual} LIKE 'decimal%'))
 OR ({expected} = 'timestamp' AND {actual} = 'timestamp_ntz') OR ({expected} LIKE 'decimal%' AND {actual} LIKE 'decimal%'))"""


def latest_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = views.declared_fields(spark, sf_dir)
    newest = registry.latest_versions(declared, version="version_label")
    return registry.at_version(declared, newest, "latest")


@register(
    "latest_schema_version",
    f"SELECT schema_name, max(CAST(substr(version_label, 2) AS INT)) AS latest FROM {DECLARED_FIELDS} GROUP BY schema_name",
)
def latest_schema_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_versions(views.declared_fields(spark, sf_dir), version="version_label")


@register(
    "version_status",
    f"""SELECT l.schema_name, u.current, l.latest, CASE WHEN u.current >= l.latest THEN 'current' ELSE 'outdated' END AS version_state
 FROM {LATEST_VERSIONS.replace(') latest_versions', ') l')} JOIN {VERSIONS_IN_USE.replace(') versions_in_use', ') u')}
 ON u.schema_name = l.schema_name""",
)
def version_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = registry.latest_versions(views.declared_fields(spark, sf_dir), version="version_label")
    return registry.version_status(views.versions_in_use(spark, sf_dir), newest)


@register(
    "type_compat",
    f"""SELECT e.schema_name, e.name, e.type AS expected, a.type AS actual, {_compatible_sql('e.type', 'a.type')} AS compatible
 FROM {LATEST_FIELDS} e JOIN {OBSERVED_FIELDS.replace(') observed_fields', ') a')} ON a.schema_name = e.schema_name AND a.name = e.name""",
)
def type_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = latest_fields(spark, sf_dir).select("schema_name", "name", F.col("type").alias("expected"))
    actual = views.observed_fields(spark, sf_dir).select("schema_name", "name", F.col("type").alias("actual"))
    both = expected.join(actual, ["schema_name", "name"])
    return both.withColumn("compatible", compatible(F.col("expected"), F.col("actual")))


DIFF_SQL = f"""SELECT coalesce(e.schema_name, a.schema_name) AS schema_name, coalesce(e.name, a.name) AS column_name,
 CASE WHEN a.name IS NULL AND NOT e.nullable THEN 'missing_required' WHEN a.name IS NULL THEN 'missing_optional'
 WHEN e.name IS NULL THEN 'extra' WHEN NOT {_compatible_sql('e.type', 'a.type')} THEN 'type' ELSE 'ok' END AS state
 FROM {LATEST_FIELDS} e FULL OUTER JOIN {OBSERVED_FIELDS.replace(') observed_fields', ') a')}
 ON a.schema_name = e.schema_name AND a.name = e.name"""


@register("schema_diff", DIFF_SQL)
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.schema_diff(latest_fields(spark, sf_dir), views.observed_fields(spark, sf_dir))


@register(
    "check_fields",
    f"""SELECT schema_name, column_name, CASE WHEN state LIKE 'missing%' THEN 'missing' ELSE state END AS issue_type,
 CASE WHEN state IN ('missing_required', 'type') THEN 'error' ELSE 'warning' END AS severity FROM ({DIFF_SQL}) q WHERE state <> 'ok'""",
)
def check_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.field_issues(schema_diff(spark, sf_dir))


@register(
    "version_diff",
    f"""WITH d AS (SELECT * FROM {DECLARED_FIELDS}),
 s AS (SELECT d.* FROM d JOIN {VERSIONS_IN_USE.replace(') versions_in_use', ') u')} ON u.schema_name = d.schema_name AND u.current = d.version),
 t AS (SELECT d.* FROM d JOIN (SELECT schema_name, max(version) AS latest FROM d GROUP BY schema_name) l
       ON l.schema_name = d.schema_name AND l.latest = d.version)
 SELECT coalesce(s.schema_name, t.schema_name) AS schema_name, coalesce(s.name, t.name) AS field,
 CASE WHEN s.name IS NULL THEN 'add' WHEN t.name IS NULL THEN 'remove'
      WHEN s.type <> t.type OR s.nullable <> t.nullable THEN 'modify' ELSE 'keep' END AS change
 FROM s FULL OUTER JOIN t ON s.schema_name = t.schema_name AND s.name = t.name""",
)
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = views.declared_fields(spark, sf_dir)
    used = registry.at_version(declared, views.versions_in_use(spark, sf_dir), "current")
    return registry.version_diff(used, latest_fields(spark, sf_dir))


CHANGES_SQL = f"""SELECT * FROM (SELECT coalesce(e.schema_name, a.schema_name) AS schema_name, coalesce(e.name, a.name) AS field,
 CASE WHEN e.name IS NULL THEN 'add_field' WHEN a.name IS NULL THEN 'remove_field'
 WHEN NOT {_compatible_sql('e.type', 'a.type')} THEN 'modify_field' END AS change,
 e.type AS old_type, a.type AS new_type, a.nullable AS nullable
 FROM {LATEST_FIELDS} e FULL OUTER JOIN {OBSERVED_FIELDS.replace(') observed_fields', ') a')}
 ON a.schema_name = e.schema_name AND a.name = e.name) q WHERE change IS NOT NULL"""


@register("infer_changes", CHANGES_SQL)
def infer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.infer_changes(latest_fields(spark, sf_dir), views.observed_fields(spark, sf_dir))


@register(
    "evolve_fields",
    f"""SELECT a.schema_name, a.name, CASE WHEN e.name IS NOT NULL AND {_compatible_sql('e.type', 'a.type')} THEN e.type ELSE a.type END AS type,
 CASE WHEN e.name IS NOT NULL AND {_compatible_sql('e.type', 'a.type')} THEN e.nullable ELSE a.nullable END AS nullable
 FROM {OBSERVED_FIELDS.replace(') observed_fields', ') a')} LEFT JOIN {LATEST_FIELDS} e ON a.schema_name = e.schema_name AND a.name = e.name""",
)
def evolve_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.evolve_fields(latest_fields(spark, sf_dir), infer_changes(spark, sf_dir))


def _issue_sql(column: str, pattern: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(CASE WHEN regexp_extract({column}, '{pattern}', 0) <> '' THEN 1 END)
 / (count(*) * 1.0e0) AS r FROM {CUSTOMER_SRC}"""


@register(
    "validation_report",
    f"""WITH p AS ({_issue_sql('email', EMAIL)} UNION ALL {_issue_sql('phone', PHONE)} UNION ALL {_issue_sql('customer_id', CUSTOMER_ID)})
 SELECT column_name, 'pattern' AS issue_type, 'warning' AS severity FROM p WHERE r < 0.9
 UNION ALL SELECT column_name, 'pattern', 'error' FROM p WHERE r < 0.5
 UNION ALL SELECT 'acctbal', 'extra', 'warning' FROM p GROUP BY 1""",
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = checks.validate(views.customer_src(spark, sf_dir), CUSTOMER_V1)
    return checks.issue_rows(report).select("column_name", "issue_type", "severity")


@register(
    "validation_summary",
    f"""WITH p AS ({_issue_sql('email', EMAIL)} UNION ALL {_issue_sql('phone', PHONE)} UNION ALL {_issue_sql('customer_id', CUSTOMER_ID)})
 SELECT (SELECT count(*) FROM customer) AS record_count, count(*) FILTER (WHERE r < 0.5) = 0 AS schema_valid,
 CAST(count(*) FILTER (WHERE r < 0.5) AS INT) AS schema_error_count, CAST(1 + count(*) FILTER (WHERE r < 0.9) AS INT) AS schema_warning_count FROM p""",
)
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validate(views.customer_src(spark, sf_dir), CUSTOMER_V1).drop("issues")


@register(
    "evolve_v1_v2",
    f"""SELECT customer_id, email, phone, address, acctbal, created_at, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
 CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, 'USA' AS country, CAST(NULL AS VARCHAR) AS postal_code,
 CAST(NULL AS TIMESTAMP) AS updated_at, 'regular' AS customer_type FROM {CUSTOMER_SRC}""",
)
def evolve_v1_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    evolved = apply_evolution(views.customer_src(spark, sf_dir), CUSTOMER_V1, CUSTOMER_V2)
    return evolved.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def _frequency_sql(position: int, column: str, kind: str) -> str:
    return f"""SELECT {position} AS position, '{column}' AS name, '{kind}' AS type, true AS nullable,
 round(count({column}) / (count(*) * 1.0e0), 6) AS frequency FROM {CUSTOMER_SRC}"""


@register(
    "schema_of_table",
    " UNION ALL ".join(
        _frequency_sql(i, c, k)
        for i, (c, k) in enumerate(
            {"customer_id": "string", "name": "string", "email": "string", "phone": "string", "address": "string",
             "acctbal": "double", "created_at": "timestamp_ntz"}.items()
        )
    ),
)
def schema_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.field_frequencies(views.customer_src(spark, sf_dir))
    return rows.withColumn("frequency", F.round("frequency", 6))


@register(
    "schema_detail",
    f"""SELECT u.schema_name, u.current, l.latest, f.field_count FROM {VERSIONS_IN_USE.replace(') versions_in_use', ') u')} LEFT JOIN {LATEST_VERSIONS.replace(') latest_versions', ') l')} ON l.schema_name = u.schema_name
 LEFT JOIN (SELECT schema_name, count(*) AS field_count FROM {DECLARED_FIELDS} GROUP BY schema_name) f ON f.schema_name = u.schema_name""",
)
def schema_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = views.declared_fields(spark, sf_dir)
    latest = fields.groupBy("schema_name").agg(F.max("version").alias("latest"))
    return monitor.schema_detail(views.versions_in_use(spark, sf_dir), latest, fields)


@register("evolved_by_registry", "SELECT c_custkey, c_name, CAST(c_acctbal AS VARCHAR) IS NULL AS no_balance, CAST(NULL AS VARCHAR) AS loyalty FROM customer")
def evolved_by_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema generated from data is registered, evolved in the registry, and data is brought to the new version."""
    path = fresh_path(spark, "registry")
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    run = Run("run-1", views.RUN_AT, registry_path=path)
    grade_source(customers, {"name": "customers"}, run)
    changes = {"add_fields": [Field("loyalty", "string")], "remove_fields": ["c_nationkey"]}
    registry.evolve(spark, path, "customers", changes, 2)
    evolved = evolve_if_needed(customers, {"name": "customers", "schema_version": 1, "target_schema_version": 2}, run)
    return evolved.select("c_custkey", "c_name", F.col("c_acctbal").isNull().alias("no_balance"), "loyalty")


# Codes of the customer table: a third are names, which do not fit the type of the second version.
CODED_V1 = SchemaDefinition("coded", 1, (Field("c_custkey", "long"), Field("code", "string"), Field("balance", "string")))
CODED_V2 = SchemaDefinition("coded", 2, (Field("c_custkey", "long"), Field("number", "int", previous_name="code"), Field("balance", "double")))


def coded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.col("c_custkey").cast("string"))
    return views.table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"), F.lit("1.5").alias("balance"))


@register(
    "evolved_with_rescue",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS INT) END AS number, 1.5e0 AS balance,
 CASE WHEN c_custkey % 3 = 0 THEN c_name END AS unfit, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS cells FROM customer""",
)
def evolved_with_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column takes a type that a third of its cells do not fit; no value is lost."""
    evolved = apply_evolution(coded_customers(spark, sf_dir), CODED_V1, CODED_V2, "rescued")
    cells = F.coalesce(F.size("rescued"), F.lit(0))
    return evolved.select("c_custkey", "number", "balance", F.try_element_at("rescued", F.lit("number")).alias("unfit"), F.greatest(cells, F.lit(0)).alias("cells"))


@register(
    "rescue_issues",
    """SELECT 'number' AS column_name, 'cast' AS issue_type, 'warning' AS severity,
 CAST(count(*) AS VARCHAR) || ' cells do not fit the new type; they are kept in _rescued' AS description FROM customer WHERE c_custkey % 3 = 0""",
)
def rescue_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports of cells that did not fit, counted in the scan that grades the data."""
    run = Run("run-1", views.RUN_AT, schemas={(d.name, d.version): d for d in (CODED_V1, CODED_V2)})
    source = {"name": "coded", "schema_version": 1, "target_schema_version": 2}
    _, row = grade_source(coded_customers(spark, sf_dir), source, run)
    issues = spark.createDataFrame(row["issues"], "column_name string, issue_type string, severity string, description string")
    return issues.where("issue_type = 'cast'")


@register(
    "evolution_requested",
    f"""SELECT 'evolution_requested' AS event_type, schema_name, count(*) AS changes, min(field) AS first_field, max(field) AS last_field
 FROM ({CHANGES_SQL}) c GROUP BY schema_name""",
)
def evolution_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred changes of every schema, left as events for someone to decide on."""
    path = fresh_path(spark, "schema-events")
    changes = cut_lineage(infer_changes(spark, sf_dir))
    for row in changes.select("schema_name").distinct().collect():
        registry.request_evolution(changes, row["schema_name"], path)
    events = spark.read.parquet(path)
    told = F.from_json("changes", "array<struct<field:string>>")
    return events.withColumn("told", told).select(
        "event_type", "schema_name", F.size("told").cast("bigint").alias("changes"),
        F.array_min("told.field").alias("first_field"), F.array_max("told.field").alias("last_field"),
    )
