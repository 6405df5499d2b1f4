"""Connected components of an edge table, in rounds of aggregates and joins."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import landed

EDGES_PER_TASK = 200_000


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("s")).first()
    return row["n"], row["s"]


def _contract(batches):
    """The edges of a task as stars: every node with the least one that these edges join it with."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    stars = [(x, r) for x in list(root) if (r := find(x)) != x]
    for start in range(0, len(stars), 50_000):
        part = stars[start : start + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], names=["a", "b"])


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """node, label: the least node of its component, for every node of ``edges`` (a, b) with an edge to another.

    Tasks of some ``edges_per_task`` edges first join what they hold themselves. Then come large and small
    stars in turn: each node hands its larger neighbours, then its smaller ones, to the least of all. A node's
    neighbours are never gathered; the table does not grow; rounds are few even for chains. Edges that one
    task holds are settled by the first step.
    """
    edges = landed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _fingerprint(edges)
    tasks = max(1, -(-before[0] // edges_per_task))

    def joined(df: DataFrame) -> DataFrame:
        return landed(df.coalesce(tasks).mapInArrow(_contract, "a bigint, b bigint"), "stars")

    edges = joined(edges)
    while tasks > 1:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = landed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")).coalesce(tasks), "least")
        edges = joined(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
        least = landed(edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), "least")
        handed = edges.join(least, "a")
        edges = joined(handed.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
