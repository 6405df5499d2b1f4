"""Schema files that change while streams run, as a stream of change events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.operators.latest import latest_per_key
from assayer.operators.registry import FIELD_TYPE, both_sides
from assayer.session import cut_lineage, list_folders, remove_path
from assayer.streaming.batches import overwrite_batch


def schema_file_stream(spark: SparkSession, folder: str, pattern: str = "*.json", one_per_file: bool = True) -> DataFrame:
    """Landed schema versions, one per file as ``<folder>/<schema>/v<n>.json``, or one per line.

    What the path does not tell is taken from the ``name`` and ``version`` in the definition.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", str(one_per_file).lower())
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("value", "_metadata.file_path")
    )
    in_path = F.regexp_extract("file_path", "([^/]+)/v[0-9]+[.]json$", 1)
    number = F.regexp_extract("file_path", "/v([0-9]+)[.]json$", 1)
    return files.select(
        F.when(in_path != "", in_path).otherwise(F.get_json_object("value", "$.name")).alias("schema_name"),
        F.when(number != "", number).otherwise(F.get_json_object("value", "$.version")).cast("int").alias("version"),
        F.col("value").alias("definition"),
    )


def record_schema_changes(registry_path: str, events_path: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Register each new schema version and append a ``schema_updated`` event with old and new definition.

    The old definition is that of the version before it, in this batch or registered earlier. A version that lands after a
    later one also leaves a ``schema_corrected`` event for that one, whose old definition it now is; of several events of
    a version the last counts (``changed_fields``). So the result does not depend on how versions are dealt into batches, nor on
    their order.

    The newest definition of every schema is kept in hash buckets beside the registry, and a batch reads and rewrites
    only the buckets of its schemas: its cost follows from the batch, not from the registry. Only schemas of
    which a version lands late are looked up in the registry. All tables are written by batch id, and a bucket keeps the
    state before its last batch, so a batch that runs twice is recorded once.
    """
    latest_path = f"{registry_path.rstrip('/')}/_latest"  # readers of the registry skip names that begin with _

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64("schema_name"), F.lit(buckets)).cast("int")
        batch = cut_lineage(batch.select("schema_name", "version", "definition", bucket.alias("bucket")))
        touched = [r[0] for r in batch.select("bucket").distinct().collect()]
        first = not list_folders(spark, latest_path)
        kept = latest_per_key(registered(spark, registry_path, batch_id).drop("batch_id").withColumn("bucket", bucket), ["schema_name"], ["version"]) if first else None
        known = kept if first else read_latest(spark, latest_path, batch_id, touched)

        names = batch.groupBy("schema_name").agg(F.min("version").alias("__least"))
        here = known.join(names, "schema_name")
        late = cut_lineage(here.where(F.col("__least") <= F.col("version")).select("schema_name", "bucket"))
        old = here.join(late.select("schema_name"), "schema_name", "left_anti").select("schema_name", "version", "definition")
        late_buckets = [r[0] for r in late.select("bucket").distinct().collect()]
        if late_buckets:
            history = registered(spark, registry_path, batch_id).where(F.col("bucket").isin(late_buckets) | F.col("bucket").isNull())
            history = history.join(late.select("schema_name"), "schema_name", "left_semi")
            old = old.unionByName(latest_per_key(history, ["schema_name", "version"], ["batch_id"]).select(*old.columns))

        new = batch.drop("bucket").withColumn("__new", F.lit(True))
        order = Window.partitionBy("schema_name").orderBy("version", "__new")
        versions = new.unionByName(old.withColumn("__new", F.lit(False)))
        lined = versions.withColumns({"old_definition": F.lag("definition").over(order), "__after_new": F.lag("__new").over(order)})
        # a version that is registered again is new itself; its earlier registration is not corrected
        lined = lined.withColumn("__again", F.lead("version").over(order) == F.col("version"))
        corrected = F.col("__after_new") & ~F.coalesce("__again", F.lit(False))
        events = lined.where(F.col("__new") | corrected).select(
            F.when(F.col("__new"), "schema_updated").otherwise("schema_corrected").alias("event_type"),
            "schema_name",
            "version",
            "old_definition",
            F.col("definition").alias("new_definition"),
            F.current_timestamp().alias("timestamp"),
        )
        overwrite_batch(events, events_path, batch_id)
        overwrite_batch(batch, registry_path, batch_id)
        if touched:
            write_latest(known, batch, latest_path, batch_id)
            for number in touched:
                retire_latest(spark, latest_path, number, batch_id)

    return handle


LATEST = "schema_name string, version int, definition string"


def registered(spark: SparkSession, registry_path: str, batch_id: int) -> DataFrame:
    """Versions that earlier batches registered."""
    columns = f"{LATEST}, bucket int, batch_id bigint"
    try:
        return spark.read.schema(columns).parquet(registry_path).where(F.col("batch_id") < batch_id)
    except AnalysisException:  # no version was registered yet
        return spark.createDataFrame([], columns)


def generations(spark: SparkSession, latest_path: str, bucket: int) -> list[int]:
    """The batches that wrote a bucket's kept states, oldest first."""
    return sorted(int(name.removeprefix("batch=")) for name in list_folders(spark, f"{latest_path}/bucket={bucket}"))


def read_latest(spark: SparkSession, latest_path: str, batch_id: int, buckets: Sequence[int]) -> DataFrame:
    """The newest definitions in some buckets, as they were before a batch."""
    found = {b: [g for g in generations(spark, latest_path, b) if g < batch_id] for b in buckets}
    paths = [f"{latest_path}/bucket={b}/batch={kept[-1]}" for b, kept in found.items() if kept]
    if not paths:
        return spark.createDataFrame([], f"{LATEST}, bucket int")
    rows = spark.read.schema(f"{LATEST}, bucket int").option("basePath", latest_path).parquet(*paths)
    return rows.select("schema_name", "version", "definition", "bucket")


def write_latest(known: DataFrame, batch: DataFrame, latest_path: str, batch_id: int) -> None:
    """Lay a batch over the kept definitions; of a version that is registered again the batch's counts."""
    both = known.select(*batch.columns).withColumn("__new", F.lit(False)).unionByName(batch.withColumn("__new", F.lit(True)))
    newest = latest_per_key(both, ["schema_name"], ["version", "__new"]).drop("__new").withColumn("batch", F.lit(batch_id))
    spread = newest.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    spread.partitionBy("bucket", "batch").parquet(latest_path)


def retire_latest(spark: SparkSession, latest_path: str, bucket: int, batch_id: int) -> None:
    """Delete a bucket's states but for a batch's and the one before it, from which the batch may be run again."""
    for old in [g for g in generations(spark, latest_path, bucket) if g < batch_id][:-1]:
        remove_path(spark, f"{latest_path}/bucket={bucket}/batch={old}")


def changed_fields(events: DataFrame) -> DataFrame:
    """Fields added, removed or changed by each version; of several events of a version the last counts."""
    order = "batch_id" if "batch_id" in events.columns else "timestamp"
    events = latest_per_key(events.select("schema_name", "version", "old_definition", "new_definition", order), ["schema_name", "version"], [order])
    fields = f"array<{FIELD_TYPE}>"

    def side(definition: str) -> DataFrame:
        listed = F.from_json(F.get_json_object(definition, "$.fields"), fields)
        return events.select("schema_name", "version", F.explode(listed).alias("f")).select(
            "schema_name", "version", "f.name", "f.type", "f.nullable"
        )

    both = both_sides(side("old_definition"), side("new_definition"), ["schema_name", "version", "name"])
    change = F.when(F.col("l").isNull(), "add").when(F.col("r").isNull(), "remove").when(F.col("l") != F.col("r"), "modify")
    return both.select("schema_name", "version", F.col("name").alias("field"), change.alias("change")).where(
        F.col("change").isNotNull()
    )
