"""Message topics as reader settings; needs Spark's Kafka package, so tests use file streams instead."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_SIZE = 10


def kafka_options(source: Mapping[str, Any]) -> dict[str, str]:
    """Reader options: one topic, starting offsets, group, rate limit and loss options, security."""
    options = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in (source.get("options") or {}).items()}
    options["kafka.bootstrap.servers"] = source["bootstrap_servers"]
    options["subscribe"] = source["topic"]
    options.setdefault("startingOffsets", source.get("starting_offsets", "latest"))
    if source.get("group_id"):
        options["kafka.group.id"] = source["group_id"]
    login = source.get("authentication")
    if login:
        options["kafka.security.protocol"] = login.get("type", "SASL_SSL")
        options["kafka.sasl.mechanism"] = login.get("mechanism", "PLAIN")
        options["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{login["username"]}" password="{login["password"]}";'
        )
    return options


def kafka_sink_options(source: Mapping[str, Any], topic: str) -> dict[str, str]:
    """Writer options of a topic on the brokers a source is read from."""
    read = kafka_options(source)
    shared = {k: v for k, v in read.items() if k.startswith("kafka.") and k != "kafka.group.id"}
    return {**shared, "topic": topic}


def read_kafka_stream(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """A topic as a stream, with the message value as text."""
    stream = spark.readStream.format("kafka").options(**kafka_options(source)).load()
    return stream.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def read_kafka_range(spark: SparkSession, source: Mapping[str, Any], limit: int | None = None) -> DataFrame:
    """What a topic holds now, from the earliest to the latest offset; ``limit`` for a sample of values."""
    options = {k: v for k, v in kafka_options(source).items() if k != "maxOffsetsPerTrigger"}
    options.update(startingOffsets="earliest", endingOffsets="latest")
    values = spark.read.format("kafka").options(**options).load()
    values = values.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
    return values if limit is None else values.limit(limit)
