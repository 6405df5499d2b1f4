"""Documents, run metrics and message rows as partitioned files, written by the executors."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayer.functions.text import daily_index
from assayer.operators.latest import latest_per_key


#: Documents in a file. Compressed files are read by one task each, so a large task writes several.
FILE_DOCUMENTS = 250_000


def write_documents(documents: DataFrame, path: str, run_id: str = "") -> tuple[int, int]:
    """Write document rows, one JSON line each, by run and index: (written, rows without content).

    A repeated run replaces its own documents of these indexes; runs, and writes of different indexes, do not
    touch each other's side by side. The counts are observed while the rows are written, so there is no second pass.
    Field names and the columns that grading adds repeat in every line, so the files are compressed.
    """
    seen = Observation()
    usable = F.col("_index").isNotNull() & F.col("_source").isNotNull()
    observed = documents.observe(
        seen, F.count_if(usable).alias("written"), F.count_if(~usable).alias("errors")
    )
    (
        observed.where(usable)
        .select("_index", F.to_json(F.struct("_id", "_source")).alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "lz4")
        .option("maxRecordsPerFile", FILE_DOCUMENTS)
        .partitionBy("_index")
        .text(f"{path}/_run={quote(run_id or 'none', safe='')}")
    )
    counts = seen.get
    return counts["written"], counts["errors"]


def read_documents(spark: SparkSession, path: str, order: Sequence[str] = ("_run",)) -> DataFrame:
    """The stored documents (_index, _id, _source): of those with an id the one of the last run, by ``order``.

    A line with an id has the text ``"_id"`` in it, which inside a JSON string would be escaped. So of the lines without
    one only those without an id are parsed, and only once: by the scan itself.
    """
    lines = spark.read.schema("value string, _run string, _index string").text(path).where(F.col("value").contains('"_id"'))
    read = lines.select("_run", "_index", F.from_json("value", "_id string, _source string").alias("d")).select("_run", "_index", "d.*")
    named = latest_per_key(read.where("_id is not null"), ["_index", "_id"], list(order))
    unnamed = spark.read.schema("_id string, _source string, _run string, _index string").json(path).where("_id is null")
    return named.select("_index", "_id", "_source").unionByName(unnamed.select("_index", "_id", "_source"))


def write_metrics(metrics: DataFrame, path: str, prefix: str = "metrics") -> None:
    """Append metrics rows (see ``stamp_metrics``) by daily index."""
    index = daily_index(prefix, F.col("`@timestamp`"))
    metrics.withColumn("_index", index).write.mode("append").partitionBy("_index").json(path)


def to_kafka_rows(
    df: DataFrame,
    topic: str,
    key: Column | None = None,
    headers: dict[str, Column] | None = None,
    moment: Column | None = None,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a message topic: JSON value with a ``_timestamp`` in epoch milliseconds, key, headers."""
    content = [F.col(c) for c in fields or df.columns]
    if "_timestamp" not in (fields or df.columns):
        stamp = F.current_timestamp() if moment is None else moment
        content.append(F.unix_millis(stamp.cast("timestamp")).alias("_timestamp"))
    rows = [
        F.lit(topic).alias("topic"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        F.to_json(F.struct(*content)).alias("value"),
    ]
    if headers:
        pairs = [F.struct(F.lit(k).alias("key"), F.encode(v.cast("string"), "UTF-8").alias("value")) for k, v in headers.items()]
        rows.append(F.array(*pairs).alias("headers"))
    return df.select(*rows)


def write_kafka(rows: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Send message rows; needs Spark's Kafka package."""
    rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).options(**options).save()
