"""A store of documents by index and id: hash buckets, rewritten where they change, committed by numbered versions.

A document's bucket follows from its index and id. A merge reads and rewrites only the buckets it touches, as files of a new
generation, and commits a version: a small table that says which generation each bucket is in. Readers see the newest
version, whole. A version's number can be claimed once, so of two writers that started from the same version one wins and the
other is told. Files that no version kept names any more go with ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.session import claim_path, fresh_path, list_folders, path_exists, remove_path

ROW = "_index string, _id string, _source string"
ENTRY = "buckets int, bucket int, generation string"
OUTCOMES = ("created", "updated", "deleted", "not_found")
ROWS_PER_FILE = 2_000_000


class VersionTaken(RuntimeError):
    """Another writer has committed, or is committing, the version that was to be written."""


def versions(spark: SparkSession, store: str) -> list[int]:
    """The numbers of the committed versions, oldest first."""
    names = [n for n in list_folders(spark, f"{store}/versions") if path_exists(spark, f"{store}/versions/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("version=")) for n in names)


def layout(spark: SparkSession, store: str, version: int | None = None) -> tuple[int, int, dict[int, str]]:
    """(version, number of buckets, generation of each bucket that has documents); version 0 is a store that is not there."""
    known = versions(spark, store)
    if version is None:
        version = known[-1] if known else 0
    elif version not in known:
        raise ValueError(f"no version {version} of {store}")
    if not version:
        return 0, 0, {}
    entries = spark.read.schema(ENTRY).parquet(f"{store}/versions/version={version}").collect()  # a row for each bucket
    return version, entries[0]["buckets"], {e["bucket"]: e["generation"] for e in entries if e["bucket"] >= 0}


def read_store(spark: SparkSession, store: str, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The documents of a version, the newest unless named, or of some of its buckets."""
    _, _, generations = layout(spark, store, version)
    paths = [f"{store}/data/generation={g}/bucket={b}" for b, g in sorted(generations.items()) if buckets is None or b in buckets]
    return spark.read.schema(ROW).parquet(*paths) if paths else spark.createDataFrame([], ROW)


def merge_documents(spark: SparkSession, store: str, changes: DataFrame, order: Sequence[str] = (), buckets: int = 64) -> dict[str, int]:
    """Apply writes and deletions (``_index``, ``_id``, ``_source``, null to delete) and say how many had which outcome.

    Of several changes of one document the last by ``order`` counts; tasks keep one before the shuffle, so an id written
    over and over is no hot spot. A document without an id gets one; changes without an index are ``errors`` and
    left out. ``buckets`` counts for a new store only.
    """
    base, held, generations = layout(spark, store)
    held = held or buckets
    path = fresh_path(spark, "document-changes")
    newest = F.struct(F.struct(*order).alias("at"), F.struct(F.col("_source")).alias("body")) if order else F.struct(F.struct(F.col("_source")).alias("body"))
    named = changes.withColumn("_id", F.coalesce(F.col("_id").cast("string"), F.uuid()))
    last = named.groupBy("_index", "_id").agg(F.max(newest).alias("newest")).select(
        "_index", "_id", F.col("newest.body._source").alias("_new"), F.pmod(F.xxhash64("_index", "_id"), F.lit(held)).cast("int").alias("bucket"))
    last.write.parquet(path)
    last = spark.read.schema(last.schema).parquet(path)
    refused = {"errors": last.where("_index is null").count()}
    last = last.where("_index is not null")
    sizes = {r["bucket"]: r["n"] for r in last.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # a row for each bucket
    if not sizes:
        return dict.fromkeys(OUTCOMES, 0) | refused

    current = read_store(spark, store, base or None, list(sizes)).withColumn("_here", F.lit(True))
    here, gone = F.col("_here").isNotNull(), F.col("_new").isNull()
    outcome = F.when(here & gone, "deleted").when(gone, "not_found").when(here, "updated").otherwise("created")
    ids = current.select("_index", "_id", "_here")
    counted = {r["outcome"]: r["n"] for r in last.join(ids, ["_index", "_id"], "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n")).collect()}
    merged, generation = current.join(last, ["_index", "_id"], "full"), f"g-{uuid.uuid4().hex}"
    stays = F.col("bucket").isNull() | ~gone
    bucket = F.pmod(F.xxhash64("_index", "_id"), F.lit(held)).cast("int")
    files = max(1, -(-max(sizes.values()) // ROWS_PER_FILE))
    rows = merged.where(stays).select("_index", "_id", F.coalesce("_new", "_source").alias("_source"), bucket.alias("bucket"), F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(files)).alias("file"))
    rows.repartition("bucket", "file").drop("file").write.partitionBy("bucket").parquet(f"{store}/data/generation={generation}")

    written = [int(n.removeprefix("bucket=")) for n in list_folders(spark, f"{store}/data/generation={generation}") if n.startswith("bucket=")]
    commit_version(spark, store, base + 1, held, {b: g for b, g in generations.items() if b not in sizes} | dict.fromkeys(written, generation))
    return {o: counted.get(o, 0) for o in OUTCOMES} | refused


def commit_version(spark: SparkSession, store: str, version: int, buckets: int, generations: dict[int, str]) -> None:
    """Make a layout the newest version, if nobody else has taken its number."""
    if not claim_path(spark, f"{store}/claims/{version}"):
        raise VersionTaken(f"version {version} of {store} is taken; merge again")
    entries = [(buckets, b, g) for b, g in sorted(generations.items())] or [(buckets, -1, None)]
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.parquet(f"{store}/versions/version={version}")


def release_claim(spark: SparkSession, store: str) -> bool:
    """Free the claim of a writer that died before it committed; only when no writer is at work."""
    known = versions(spark, store)
    number = (known[-1] if known else 0) + 1
    remove_path(spark, f"{store}/versions/version={number}")
    return remove_path(spark, f"{store}/claims/{number}")


def vacuum(spark: SparkSession, store: str, keep: int = 1) -> int:
    """Delete the buckets of generations that none of the last ``keep`` versions names, and say how many. Not beside a merge."""
    named = set()
    for version in versions(spark, store)[-max(keep, 1) :]:
        named |= {(g, b) for b, g in layout(spark, store, version)[2].items()}
    gone = 0
    for folder in list_folders(spark, f"{store}/data"):
        generation, left = folder.removeprefix("generation="), 0
        for name in list_folders(spark, f"{store}/data/{folder}"):
            if name.startswith("bucket="):
                if (generation, int(name.removeprefix("bucket="))) in named:
                    left += 1
                else:
                    gone += remove_path(spark, f"{store}/data/{folder}/{name}")
        if not left:
            remove_path(spark, f"{store}/data/{folder}")
    return gone
