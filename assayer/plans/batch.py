"""One source from read to write, and all sources of a configuration."""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from assayer.functions.text import document_index
from assayer.operators.checks import check_aggregates, checks_of, result_columns
from assayer.operators.documents import document_rows, stamp_metrics
from assayer.operators.monitor import run_totals
from assayer.operators.profile import profile_columns
from assayer.operators.registry import append_events, get_version, has_schema, register_versions
from assayer.operators.schema import SchemaDefinition, apply_evolution, definition_from_frame, rescue_counts, version_number
from assayer.operators.runlog import write_run_log
from assayer.operators.scoring import TIER_THRESHOLDS, QualitySpec, count_aggregates, score_columns
from assayer.operators.tiering import add_quality_columns, classify, merge_thresholds
from assayer.session import cut_lineage, fresh_path
from assayer.sinks.documents import write_documents, write_metrics
from assayer.sinks.published import commit, published, write_attempt
from assayer.sinks.tiers import retire_older_files, retire_older_partitions, write_rejected, write_tier_files, write_with_fallback
from assayer.sources.catalog import read_table
from assayer.sources.config import all_sources, find_source
from assayer.sources.cve import filter_cves, published_between, read_cve_pages
from assayer.sources.files import declared_struct, read_files
from assayer.sources.incremental import advance_high_water, incremental_scan, load_high_water, retain_days
from assayer.sources.jdbc import read_jdbc
from assayer.sources.kafka import read_kafka_range
from assayer.sources.ledger import Ledger, begin_load, end_load, holds_for, load_ledger, unseen_rows
from assayer.sources.payloads import (
    csv_payload_rows,
    decode_values,
    infer_element,
    normalise_pages,
    split_decoded,
    xml_payload_rows,
)

log = logging.getLogger(__name__)

RESULT_SCHEMA = (
    "run_id string, seq bigint, source_name string, source_type string, status string, classification string, "
    "record_count bigint, completeness double, accuracy double, timeliness double, schema_valid boolean, "
    "finished_at timestamp_ntz, message string, report_error string"
)
ISSUE_FIELDS = "column_name string, issue_type string, severity string, description string"
ISSUE_SCHEMA = f"run_id string, source_name string, {ISSUE_FIELDS}"


@dataclass
class Run:
    """What all sources of a run share.

    Without ``target_paths`` nothing is written. ``monitor_path`` is the folder of the monitoring
    tables (source_runs, pipeline_runs, issues, column_profile, schema_events), ``documents_path``
    that of the optional document store. Schemas that are not given are looked up in the registry
    table, where sources without any leave the one generated from their data. ``state_path`` keeps the
    marks of incremental loads. ``tables`` (the options of ``write_tier_table``) sends data to tier
    tables, and to files only where that fails. ``profile`` adds column profiles to the reports.
    With ``store_path`` data is published by manifest instead: written once, to its final place
    (see ``sinks.published``).
    """

    run_id: str
    run_at: datetime
    target_paths: Mapping[str, str] = field(default_factory=dict)
    thresholds: Mapping[str, Mapping[str, float]] = field(default_factory=lambda: TIER_THRESHOLDS)
    schemas: Mapping[tuple[str, int], SchemaDefinition] = field(default_factory=dict)
    monitor_path: str | None = None
    documents_path: str | None = None
    registry_path: str | None = None
    state_path: str | None = None
    tables: Mapping[str, Any] | None = None
    profile: bool = False
    store_path: str | None = None

    def definition(
        self, spark: SparkSession, name: str, version: int | str | None = None
    ) -> SchemaDefinition | None:
        """A schema by name, in the newest version unless one is named; None if there is no such schema."""
        versions = {v: d for (n, v), d in self.schemas.items() if n == name}
        if not versions:
            return self._registered(spark, name, version)
        wanted = max(versions) if version in (None, "latest") else version_number(version)
        if wanted not in versions:
            raise ValueError(f"no schema {name!r} in version {version!r}")
        return versions[wanted]

    def _registered(self, spark: SparkSession, name: str, version: int | str | None) -> SchemaDefinition | None:
        if not self.registry_path or not has_schema(spark, self.registry_path, name):
            return None
        return get_version(spark, self.registry_path, name, version or "latest")


def read_source(spark: SparkSession, family: str, source: Mapping[str, Any]) -> DataFrame:
    """Read a source by family."""
    if family == "file":
        if source.get("table_name"):
            return read_table(spark, source["table_name"], source.get("database"))
        declared = declared_struct(source["schema"]) if source.get("schema") else None
        return read_files(spark, source["path"], source["format"], source.get("options"), declared)
    if family == "database":
        return read_jdbc(spark, source)
    if family == "api":
        return read_api(spark, source)
    if family == "kafka":
        return decode_values(cut_lineage(read_kafka_range(spark, source)), source.get("value_schema"))
    if family == "nvd":
        cves = read_cve_pages(
            read_files(spark, source["path"], "parquet"),
            source.get("results_per_page", 2000),
            source.get("max_pages"),
        )
        start, end = (datetime.fromisoformat(source[k]) if source.get(k) else None for k in ("start_date", "end_date"))
        return filter_cves(published_between(cves, start, end), source.get("additional_query_params", {}))
    raise ValueError(f"unknown source family {family!r}")


def read_api(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """Rows of an interface's landed responses: JSON pages in a table, CSV or XML files."""
    kind = source.get("response_format", "json")
    if kind == "csv":
        return csv_payload_rows(spark, source["path"], source.get("schema"), multiLine="true")
    if kind == "xml":
        return xml_payload_rows(spark, source["path"], source.get("xml_row_tag", "row"), source.get("schema"))
    if kind != "json":
        raise ValueError(f"unsupported response format {kind!r}")
    pages = read_files(spark, source["path"], "parquet")
    paging, results_path = source.get("pagination", {}), source.get("results_path", "")
    element = source.get("element") or infer_element(pages, results_path)
    if element is None:
        raise ValueError("no page has results to take their type from")
    items = normalise_pages(
        pages,
        element,
        results_path,
        paging.get("has_more_path"),
        paging.get("next_page_link_path"),
        paging.get("max_pages"),
    )
    return items.select("item.*")


def quality_spec(source: Mapping[str, Any], thresholds: Mapping[str, Mapping[str, float]], streaming: bool = False) -> QualitySpec:
    """Scoring rules of a source's settings; its own thresholds lie over the defaults."""
    return QualitySpec(
        name=source.get("name", "unnamed_source"),
        rules=source.get("validation_rules", {}),
        date_column=source.get("datetime_column"),
        max_age_days=source.get("classification_rules", {}).get("timeliness", 30),
        streaming=source.get("streaming", streaming),
        thresholds=merge_thresholds(thresholds, source.get("classification_thresholds")),
    )


RESCUED = "_rescued"  # cells that did not fit a new type; kept with the data, and no part of what is graded
LOST = "__rescued_"


def assessment_aggregates(df: DataFrame, spec: QualitySpec, checked: SchemaDefinition, as_of=None) -> list[Column]:
    """All that has to be counted of a dataset, as aggregate columns of one scan."""
    graded = df.drop(RESCUED)
    lost = [count.alias(LOST + column) for column, count in rescue_counts(df, RESCUED).items()]
    return [*count_aggregates(graded, spec, as_of), *check_aggregates(graded, checked), *[metric.alias(name) for name, metric in spec.metrics.items()], *lost]


def judge(counted: DataFrame, df: DataFrame, spec: QualitySpec, definition: SchemaDefinition | None, checked: SchemaDefinition) -> DataFrame:
    """Scores, schema result with issues, and tier, from the one row of counts of ``df``."""
    scored = counted.withColumns(score_columns(spec, spec.date_column in df.columns))
    judged = scored.withColumns(result_columns(checks_of(df.drop(RESCUED), checked)))
    if definition is None:  # the generated schema fits by construction; say that it was generated
        judged = judged.withColumns({"schema_warning_count": F.lit(1), "issues": generated_issue(judged)})
    if lost := list(rescue_counts(df, RESCUED)):
        judged = judged.withColumns({
            "schema_warning_count": F.col("schema_warning_count") + sum((F.col(LOST + c) > 0).cast("int") for c in lost),
            "issues": F.concat("issues", rescue_issues(judged, lost)),
        }).drop(*(LOST + c for c in lost))
    return classify(judged, spec.thresholds, F.col("schema_valid"))


def generated_issue(judged: DataFrame) -> Column:
    """The issue of a source without a schema."""
    kind = judged.schema["issues"].dataType
    values = {"severity": "warning", "issue_type": "schema_generated", "description": "No schema was given; one was generated from the data"}
    fields = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in kind.elementType.fields]
    return F.array(F.struct(*fields)).cast(kind)


def rescue_issues(judged: DataFrame, columns: list[str]) -> Column:
    """A warning for each column of which cells did not fit its new type."""
    kind = judged.schema["issues"].dataType

    def issue(column: str) -> Column:
        said = F.concat(F.col(LOST + column).cast("string"), F.lit(f" cells do not fit the new type; they are kept in {RESCUED}"))
        values = {"column_name": F.lit(column), "severity": F.lit("warning"), "issue_type": F.lit("cast"), "description": said}
        fields = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.elementType.fields]
        return F.when(F.col(LOST + column) > 0, F.struct(*fields))

    return F.filter(F.array(*(issue(c) for c in columns)), lambda i: i.isNotNull()).cast(kind)


def assess(df: DataFrame, spec: QualitySpec, definition: SchemaDefinition | None, as_of=None) -> DataFrame:
    """Counts, scores, schema result with issues, and tier of a dataset: one row from one aggregate scan."""
    checked = definition or definition_from_frame(df, spec.name)
    return judge(df.agg(*assessment_aggregates(df, spec, checked, as_of)), df, spec, definition, checked)


def stage_and_assess(df: DataFrame, spec: QualitySpec, definition: SchemaDefinition | None, as_of=None) -> tuple[DataFrame, Row]:
    """(the data, written to the shared folder, its assessment), in one pass: the counts are observed on the write."""
    spark, checked, path = df.sparkSession, definition or definition_from_frame(df, spec.name), fresh_path(df.sparkSession, "staged")
    counts, seen = assessment_aggregates(df, spec, checked, as_of), Observation()
    df.observe(seen, *counts).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), judge_counts(df, counts, seen.get, spec, definition, checked)


def judge_counts(
    df: DataFrame, counts: list[Column], seen: Mapping[str, Any], spec: QualitySpec, definition: SchemaDefinition | None, checked: SchemaDefinition
) -> Row:
    """The assessment that observed counts of ``df`` amount to. They are constants, so no job runs."""
    one = df.sparkSession.sql("SELECT * FROM VALUES (0) AS one(__none)")
    counted = one.select(*(F.lit(seen.get(f.name)).cast(f.dataType).alias(f.name) for f in df.agg(*counts).schema.fields))
    return judge(counted, df, spec, definition, checked).first()


def evolve_if_needed(df: DataFrame, source: Mapping[str, Any], run: Run) -> DataFrame:
    """Bring data to the target schema version, if the source names one; on failure leave it as it is.

    Cells that do not fit a new type are kept in the column ``_rescued`` and reported as issues.
    """
    target, current = source.get("target_schema_version"), source.get("schema_version", "latest")
    if not target or target == current:
        return df
    try:
        old, new = (run.definition(df.sparkSession, source["name"], version) for version in (current, target))
        return df if old is None or new is None else apply_evolution(df, old, new, RESCUED)
    except (ValueError, AnalysisException) as failure:
        log.warning("%s was not evolved: %s", source["name"], failure)
        return df


def grade_source(df: DataFrame, source: Mapping[str, Any], run: Run, streaming: bool = False) -> tuple[DataFrame, Any]:
    """(the evolved data with quality columns, the one assessment row); a generated schema is registered."""
    graded, row, generated = stage_and_grade(df, source, run, streaming)
    if generated is not None and run.registry_path:
        register_versions(df.sparkSession, run.registry_path, [generated])
    return graded, row


def stage_and_grade(
    df: DataFrame, source: Mapping[str, Any], run: Run, streaming: bool = False
) -> tuple[DataFrame, Any, SchemaDefinition | None]:
    """(the evolved data with quality columns, its assessment, the schema generated for it if it had none)."""
    evolved, spec, definition, generated = to_be_graded(df, source, run, streaming)
    staged, row = stage_and_assess(evolved, spec, definition, run.run_at)
    return add_quality_columns(staged, row, spec.name, run.run_at), row, generated


def publish_source(
    df: DataFrame, source: Mapping[str, Any], run: Run, streaming: bool = False
) -> tuple[DataFrame, Any, SchemaDefinition | None]:
    """As ``stage_and_grade``, but written once, to the place where the data stays, and committed by the manifest."""
    spark = df.sparkSession
    evolved, spec, definition, generated = to_be_graded(df, source, run, streaming)
    checked = definition or generated
    counts = assessment_aggregates(evolved, spec, checked, run.run_at)
    attempt, seen = write_attempt(evolved, run.store_path, spec.name, counts)
    row = judge_counts(evolved, counts, seen, spec, definition, checked)
    commit(spark, run.store_path, spec.name, run.run_id, attempt, row, run.run_at)
    return published(spark, run.store_path, spec.name, run_id=run.run_id).drop("run_id"), row, generated


def to_be_graded(
    df: DataFrame, source: Mapping[str, Any], run: Run, streaming: bool
) -> tuple[DataFrame, QualitySpec, SchemaDefinition | None, SchemaDefinition | None]:
    """(the evolved data, its scoring rules, its schema if it has one, else the schema generated for it)."""
    evolved = evolve_if_needed(df, source, run)
    spec = quality_spec(source, run.thresholds, streaming)
    version = source.get("target_schema_version") or source.get("schema_version", "latest")
    definition = run.definition(df.sparkSession, spec.name, version)
    return evolved, spec, definition, definition_from_frame(evolved.drop(RESCUED), spec.name) if definition is None else None


@dataclass
class Report:
    """What is to be kept of a source besides its data. All sources' reports of a run are written together."""

    name: str
    graded: DataFrame | None = None
    row: Any = None
    generated: SchemaDefinition | None = None
    profile: bool = False


def process_source(spark: SparkSession, family: str, source: Mapping[str, Any], run: Run, seq: int = 0) -> tuple:
    """Read, evolve, grade and write one source with its reports, and say how it went (a row of ``RESULT_SCHEMA``)."""
    result, report = treat_source(spark, family, source, run, seq)
    return with_reports(spark, [(result, report)], run)[0]


def treat_source(spark: SparkSession, family: str, source: Mapping[str, Any], run: Run, seq: int = 0) -> tuple[tuple, Report]:
    """The result row of a source and what there is to report of it.

    The source is read once: what is graded is staged in the shared folder while it is counted, and
    tier, dead letters and reports come from there. Any failure is this source's own and becomes
    a failed result. The mark of an incremental load moves after the write.
    """
    name = source.get("name", "unnamed_source")
    try:
        df, load = fresh_rows(spark, family, source, run)
        if family == "kafka":
            df = keep_dead_letters(df, name, run)
        if load is not None:
            begin_load(spark, run.state_path, name, load.high_water)
        if run.store_path:
            graded, row, generated = publish_source(df, source, run, family == "kafka")
        else:
            graded, row, generated = stage_and_grade(df, source, run, family == "kafka")
            write_graded(graded, row, source, run)
        tier = row["data_classification"]
        if load is not None:
            remember_load(spark, df, graded, source, load, run)
        result = (
            run.run_id, seq, name, family, "success", tier, row["record_count"], row["completeness"],
            row["accuracy"], row["timeliness"], row["schema_valid"], run.run_at, None, None,
        )
        return result, Report(name, graded, row, generated, source.get("profile", run.profile))
    except Exception as failure:
        reason = str(failure).split("\n", 1)[0]
        log.warning("source %s failed: %s", name, reason)
        return (run.run_id, seq, name, family, "failed", None, 0, None, None, None, None, run.run_at, reason, None), Report(name)


@dataclass
class Load:
    """Where an incremental load stands: the mark before it, and the ledger if it holds."""

    high_water: datetime | None
    ledger: Ledger | None


def fresh_rows(spark: SparkSession, family: str, source: Mapping[str, Any], run: Run) -> tuple[DataFrame, Load | None]:
    """A source's rows: all of them, or with ``incremental`` those that no earlier load has written; and its load.

    ``incremental`` names the ``column`` of the last change and the ``keys`` of a row; ``retention`` a
    ``column`` and a number of ``days``. Rows that were loaded are known by the ledger; where none holds, by what was written.
    """
    df = read_source(spark, family, source)
    if retention := source.get("retention"):
        df = retain_days(df, retention["column"], retention["days"], run.run_at)
    settings = source.get("incremental")
    if not settings or not run.state_path:
        return df, None
    name, keys = source.get("name", "unnamed_source"), settings.get("keys")
    ledger = load_ledger(spark, run.state_path, name)
    if holds_for(ledger, df, keys):
        return unseen_rows(df, settings["column"], ledger), Load(ledger.high_water, ledger)
    mark = load_high_water(spark, run.state_path, name)
    return incremental_scan(df, settings["column"], mark, loaded_rows(spark, name, run), keys), Load(mark, None)


def remember_load(spark: SparkSession, df: DataFrame, graded: DataFrame, source: Mapping[str, Any], load: Load, run: Run) -> None:
    """Move the mark and enter the written rows in the ledger.

    Keys that evolution renames or casts cannot be entered from written rows: then only the mark moves, and the next load
    compares with the written rows.
    """
    name, settings = source.get("name", "unnamed_source"), source["incremental"]
    columns = settings.get("keys") or df.columns
    written = {f.name: f.dataType for f in graded.schema.fields}
    if any(written.get(c) != df.schema[c].dataType for c in [*columns, settings["column"]]):
        advance_high_water(graded, settings["column"], run.state_path, name)
        return
    loaded = loaded_rows(spark, name, run) if load.ledger is None and load.high_water is not None else None
    end_load(graded, settings["column"], columns, run.state_path, name, load.high_water, load.ledger, loaded)


def loaded_rows(spark: SparkSession, name: str, run: Run) -> DataFrame | None:
    """What earlier runs wrote of a source, in whatever tier; None if nothing."""
    if run.store_path:
        try:
            return published(spark, run.store_path, name)
        except ValueError:
            return None
    found = None
    for folder in run.target_paths.values():
        try:
            rows = spark.read.parquet(f"{folder.rstrip('/')}/{name}")
        except AnalysisException:  # nothing of it in this tier
            continue
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def keep_dead_letters(df: DataFrame, name: str, run: Run) -> DataFrame:
    """The decoded messages; those that cannot be decoded go to ``dead_letters`` with key, offset and time."""
    rows, dead = split_decoded(df)
    if run.monitor_path:
        path = f"{run.monitor_path}/dead_letters/failed_run={quote(run.run_id, safe='')}/failed_source={quote(name, safe='')}"
        dead.write.mode("overwrite").parquet(path)
    return rows


def write_graded(graded: DataFrame, row: Any, source: Mapping[str, Any], run: Run) -> None:
    """Write the data where its tier belongs: rejected data with its issues, the rest to tables or files as configured.

    Copies that an earlier try of this run left elsewhere, under another grade, go once the new one is there.
    """
    tier, name, spark, where = row["data_classification"], source.get("name", "unnamed_source"), graded.sparkSession, None
    if tier == "rejected" and run.target_paths:
        issues = spark.createDataFrame([(tier, *issue) for issue in row["issues"]], f"classification string, {ISSUE_FIELDS}")
        write_rejected(graded, issues, name, run.run_id, run.target_paths, run.run_at)
        where = "files"
    elif run.tables is not None:
        where, _ = write_with_fallback(graded, tier, name, run.target_paths, run.run_at, run.run_id, **run.tables)
    elif run.target_paths:
        write_tier_files(graded, tier, name, run.target_paths, run.run_at, run.run_id)
        where = "files"
    if where and run.target_paths:
        retire_older_files(spark, tier if where == "files" else None, name, run.target_paths, run.run_at.date(), run.run_id)
    if where and run.tables is not None:
        try:
            retire_older_partitions(spark, tier if where == "table" else None, name, run.run_at.date(), run.run_id, **run.tables)
        except Exception as failure:  # the table store that was down for the write
            log.warning("older partitions of %s are still there: %s", name, str(failure).split("\n", 1)[0])


def with_reports(spark: SparkSession, treated: list[tuple[tuple, Report]], run: Run, at_once: int = 1) -> list[tuple]:
    """Write the reports of all sources together, each table once, and documents of some sources side by side; result
    rows say what could not be written.

    The primary writes have succeeded by then, and that is what a result's status counts.
    """
    done = [report for _, report in treated if report.graded is not None]
    writers = {
        "issues": lambda: write_issues(spark, done, run),
        "events": lambda: write_events(spark, done, run),
        "schemas": lambda: write_generated(spark, done, run),
        "profile": lambda: write_profiles(done, run),
    }
    failed = []
    for what, write in writers.items():
        try:
            write()
        except Exception as failure:
            log.warning("the %s of run %s were not written: %s", what, run.run_id, str(failure).split("\n", 1)[0])
            failed.append(f"{what}: {str(failure).split(chr(10), 1)[0]}")
    lost = write_all_documents(spark, done, run, at_once)
    rows = []
    for result, report in treated:
        said = [*failed, *lost.get(id(report), [])] if report.graded is not None else []
        rows.append((*result[:-1], "; ".join(said) or None))
    return rows


def write_all_documents(spark: SparkSession, reports: list[Report], run: Run, at_once: int = 1) -> dict[int, list[str]]:
    """Write the documents of all sources, some side by side, and say by report what could not be written.

    Sources of one index, as names differ in case only, are written one after the other, in their order.
    """
    if not run.documents_path:
        return {}
    by_index: dict[str, list[Report]] = {}
    for report in reports:
        by_index.setdefault(report.name.lower(), []).append(report)
    lost: dict[int, list[str]] = {}

    def write(number: int, same: list[Report]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"documents-{number}")
        try:
            for report in same:
                try:
                    index = document_index(F.col("data_classification"), F.lit(report.name), F.lit(run.run_at.date()))
                    write_documents(document_rows(report.graded, index), run.documents_path, f"{run.run_at:%Y%m%dT%H%M%S}-{run.run_id}")
                except Exception as failure:
                    reason = str(failure).split("\n", 1)[0]
                    log.warning("the documents of %s were not written: %s", report.name, reason)
                    lost[id(report)] = [f"documents: {reason}"]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(lambda item: write(*item), enumerate(by_index.values())))
    return lost


def write_issues(spark: SparkSession, reports: list[Report], run: Run) -> None:
    issues = [(run.run_id, report.name, *issue) for report in reports for issue in report.row["issues"]]
    if run.monitor_path and issues:
        spark.createDataFrame(issues, ISSUE_SCHEMA).write.mode("append").parquet(f"{run.monitor_path}/issues")


def write_events(spark: SparkSession, reports: list[Report], run: Run) -> None:
    if run.monitor_path and reports:
        append_events(spark, f"{run.monitor_path}/schema_events", [
            ("schema_validated", report.name, None,
             json.dumps({"is_valid": report.row["schema_valid"], "errors": report.row["schema_error_count"], "warnings": report.row["schema_warning_count"]}),
             run.run_id)
            for report in reports
        ])


def write_generated(spark: SparkSession, reports: list[Report], run: Run) -> None:
    generated = [report.generated for report in reports if report.generated is not None]
    if run.registry_path and generated:
        register_versions(spark, run.registry_path, generated)


def write_profiles(reports: list[Report], run: Run) -> None:
    if run.monitor_path:
        for report in reports:
            if report.profile:
                profile_source(report.graded, report.name, run)


def profile_source(df: DataFrame, name: str, run: Run, distinct: str = "approx") -> None:
    """Append the column profile of a source to the monitoring tables."""
    rows = profile_columns(df.drop(RESCUED), distinct=distinct)
    rows.withColumns({"run_id": F.lit(run.run_id), "source_name": F.lit(name)}).write.mode("append").parquet(
        f"{run.monitor_path}/column_profile"
    )


def process_one(spark: SparkSession, config: Mapping[str, Any], name: str, run: Run) -> DataFrame:
    """Process one source by name."""
    family, source = find_source(config, name)
    return spark.createDataFrame([process_source(spark, family, source, run)], RESULT_SCHEMA)


def process_all(spark: SparkSession, config: Mapping[str, Any], run: Run, at_once: int = 4) -> DataFrame:
    """Process every enabled source in family order: one result row per source.

    Some sources run side by side, so that small ones do not leave a cluster idle; each has a scheduler pool of its own, so that
    with ``spark.scheduler.mode`` FAIR a large source does not hold up the jobs of small ones for longer than its running tasks take. A source with
    ``time_limit_seconds`` is cancelled at its limit and fails alone. The reports are written together afterwards, documents
    of as many sources side by side. With a monitoring folder the results, the run's totals and its log lines are appended to its tables.
    """
    started = time.time()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        treated = list(pool.map(lambda item: treat_side_by_side(spark, item[1][0], item[1][1], run, item[0]), enumerate(all_sources(config))))
    results = spark.createDataFrame(with_reports(spark, treated, run, at_once), RESULT_SCHEMA)
    if run.monitor_path:
        results.write.mode("append").parquet(f"{run.monitor_path}/source_runs")
        record = run_record(results, run, "batch", started)
        record.write.mode("append").parquet(f"{run.monitor_path}/pipeline_runs")
        write_metrics(stamp_metrics(record, run.run_at), f"{run.monitor_path}/metrics")
        write_run_log(results, record, f"{run.monitor_path}/run_log", run.run_id)
    return results


def treat_side_by_side(spark: SparkSession, family: str, source: Mapping[str, Any], run: Run, seq: int) -> tuple[tuple, Report]:
    """``treat_source`` in a scheduler pool and under a job tag of its own, within the source's time limit.

    At the limit all jobs with the tag are cancelled, and so is every further one until the source has failed, so that no
    fallback goes on behind it. What it wrote before is treated as that of any failed source: its run id is tried again.
    """
    name, limit = source.get("name", "unnamed_source"), source.get("time_limit_seconds")
    context, tag, ended, late = spark.sparkContext, f"source-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if not ended.wait(float(limit)):
            late.set()
        while not ended.wait(0.2):
            context.cancelJobsWithTag(tag)

    context.setLocalProperty("spark.scheduler.pool", f"source-{seq}")
    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True) if limit is not None else None
    try:
        if watcher:
            watcher.start()
        result, report = treat_source(spark, family, source, run, seq)
    finally:
        ended.set()
        if watcher:
            watcher.join()
        context.removeJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", None)
    if late.is_set() and result[4] == "failed":
        result = (*result[:-2], f"{name} was stopped at its time limit of {limit} s", None)
    return result, report


def run_record(results: DataFrame, run: Run, mode: str, started: float) -> DataFrame:
    """The run's row of the ``pipeline_runs`` table; ``started`` is a clock reading in seconds."""
    totals = run_totals(results).drop("start_time", "end_time", "duration_seconds")
    took = time.time() - started
    return totals.select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(mode).alias("mode"),
        F.timestamp_seconds(F.lit(started)).alias("start_time"),
        F.timestamp_seconds(F.lit(started + took)).alias("end_time"),
        F.lit(took).alias("duration_seconds"),
        "*",
    )
