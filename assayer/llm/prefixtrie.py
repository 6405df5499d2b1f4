"""The trie of all prefixes of conversations, screened by a count-min sketch.

Each different sequence of first turns is a node; conversations that start with it are its members.

1. A prefix has a digest of 128 bits: the exclusive or of the hashes of its turns and their places. Turns lie packed,
   some thousand to a row, so digests of all prefixes of a conversation are made where it lies.
2. A count-min sketch counts the digests of all prefixes; its estimates are never too low. Estimate one proves that a
   prefix has one member, and so have all longer ones: these tails are whole nodes, emitted where they are.
3. Only prefixes that may be shared travel: nodes, members and children are exact aggregates by digest.
4. The member with the smallest id owns a node, and owns all of its own longer prefixes. So a member's share of what a
   subtree saves is what it has from there up to its first own node, and sums over subtrees are sums over members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import landed
from assayer.llm.jaccard import mixed

CHUNK = 1024
SKETCH_ROWS, SKETCH_LEAST, SKETCH_MOST = 3, 1 << 16, 1 << 24
SLICE = 1 << 16
MEMBER, HEAD, TAIL = 0, 1, 2
NODE = ["depth", "d1", "d2"]
_U = np.uint64


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, at (1, 2, ...), one, other (hashes of role and text), chars of every turn of ``conversations``.

    Turns come by ``turn``, null first; those of one number in an order of their hashes. Null roles and texts are empty;
    rows without a conv_id are left out. A conversation of any length is numbered in many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), "turn", F.xxhash64(role, text).alias("one"), F.xxhash64(F.lit(7), text, role).alias("other"),
        F.char_length(text).cast("bigint").alias("chars"), F.rand(7).alias("salt"))
    order = ["turn", "one", "other", "salt"]
    spread = landed(turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    counted = landed(spread.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "trie-parts")
    several = counted.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    upto = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.join(several, "conv_id", "left_semi").select("conv_id", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    own = spread.withColumn("at", F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)))
    at = F.col("at") + F.coalesce("before", F.lit(0))
    return own.join(before, ["conv_id", "part"], "left").select("conv_id", at.alias("at"), "one", "other", "chars")


def rebuilt(turns: DataFrame, every: int = 100, shared: int = 6) -> DataFrame:
    """conv_id, last, at, one, other, chars: each conversation c with the first h turns of conversation c - c % ``every``, then its
    own turns after the first h; h = crc32(c as text) % ``shared``. Each also has a row at place 0."""
    turns = landed(turns, "trie-numbered")
    sizes = landed(turns.groupBy("conv_id").agg(F.count("*").alias("own")), "trie-sizes")
    convs = sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared, "base": F.col("conv_id") - F.col("conv_id") % every})
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = landed(convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("last")), "trie-convs")
    columns = ["conv_id", "last", "at", "one", "other", "chars"]
    kept = turns.join(convs, "conv_id").where("at > h").withColumn("at", F.col("at") - F.col("h") + F.col("taken")).select(*columns)
    first = turns.where(F.col("at") < shared).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(first, "base").where("at <= taken").select(*columns)
    nothing = F.lit(0).cast("bigint")
    return kept.unionByName(borrowed).unionByName(convs.select("conv_id", "last", *(nothing.alias(c) for c in columns[2:])))


def packed(steps: DataFrame) -> DataFrame:
    """One row for each CHUNK places of a conversation: its turns in order, and what those before them amount to."""
    place = F.col("at").cast("bigint")
    turn = F.struct(place.alias("at"), F.when(place > 0, F.xxhash64("one", "other", "at")).otherwise(F.lit(0)).alias("g1"),
                    F.when(place > 0, F.xxhash64("at", "other", "one", F.lit(3))).otherwise(F.lit(0)).alias("g2"), "chars")
    rows = steps.select("conv_id", "last", F.floor(place / CHUNK).alias("chunk"), turn.alias("turn")).groupBy("conv_id", "chunk").agg(
        F.max("last").alias("last"), F.sort_array(F.collect_list("turn")).alias("turns"),
        F.bit_xor("turn.g1").alias("x1"), F.bit_xor("turn.g2").alias("x2"), F.sum("turn.chars").alias("chars"))
    rows = landed(rows, "trie-chunks")
    upto = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.where(F.col("last") >= CHUNK).select(
        "conv_id", "chunk", F.bit_xor("x1").over(upto).alias("b1"), F.bit_xor("x2").over(upto).alias("b2"), F.sum("chars").over(upto).alias("before"))
    zero = F.lit(0).cast("bigint")
    return landed(rows.drop("x1", "x2", "chars").join(before, ["conv_id", "chunk"], "left").select(
        "conv_id", "last", "turns", *(F.coalesce(c, zero).alias(c) for c in ("b1", "b2", "before"))), "trie-packed")


def unpacked(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Flat columns of a batch of packed rows: row, starts, at, d1, d2 (digests), p1, p2 (those without the last turn), chars, before."""
    lists = batch.column(2)
    flat = lists.flatten()
    sizes = np.diff(np.asarray(lists.offsets))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), sizes)
    at, g1, g2, chars = (np.asarray(flat.field(i)) for i in range(4))
    b1, b2, before = (np.asarray(batch.column(i)) for i in (3, 4, 5))
    out = {"row": row, "starts": starts, "at": at, "chars": chars}
    for name, g, b in (("1", g1, b1), ("2", g2, b2)):
        upto = np.bitwise_xor.accumulate(g) if len(g) else g
        out["d" + name] = upto ^ (upto[starts] ^ g[starts] ^ b)[row]
        out["p" + name] = out["d" + name] ^ g
    upto = np.cumsum(chars)
    out["before"] = upto - chars - (upto[starts] - chars[starts] - before)[row]
    return out


def sketch_places(flat: dict[str, np.ndarray], width: int) -> list[np.ndarray]:
    """The counters of each prefix in every row of the sketch."""
    seed = mixed(flat["d1"].view(np.uint64) ^ mixed(flat["d2"].view(np.uint64) + flat["at"].view(np.uint64)))
    return [(mixed(seed + _U((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & _U(width - 1)).astype(np.int64) for r in range(SKETCH_ROWS)]


def count_min(rows: DataFrame, width: int) -> np.ndarray:
    """SKETCH_ROWS x ``width`` counters of all prefixes but the empty one, held at 2: no more has to be told apart."""
    slices = max(1, width // SLICE)
    size = width // slices

    def count(batches):
        table = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
        for batch in batches:
            flat = unpacked(batch)
            for r, places in enumerate(sketch_places(flat, width)):
                which, times = np.unique(places[flat["at"] > 0], return_counts=True)
                table[r, which] = np.minimum(table[r, which] + np.minimum(times, 2), 2)
        parts = [(r * slices + s, table[r, s * size : (s + 1) * size]) for r in range(SKETCH_ROWS) for s in range(slices)]
        parts = [(n, p.tobytes()) for n, p in parts if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], names=["slice", "data"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mine = np.frombuffer(data, dtype=np.uint8)
                held[number] = np.minimum(held[number] + mine, 2) if number in held else mine
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([p.tobytes() for p in held.values()], pa.binary())], names=["slice", "data"])

    schema = "slice int, data binary"
    table = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
    for row in rows.mapInArrow(count, schema).repartition("slice").mapInArrow(merge, schema).toLocalIterator():
        r, s = divmod(row["slice"], slices)
        table[r, s * size : (s + 1) * size] = np.frombuffer(row["data"], dtype=np.uint8)
    return table


def screened(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """kind, conv_id, depth, d1, d2, p1, p2, chars, before, is_end of all prefixes.

    MEMBER: a prefix that may be shared. HEAD: the first prefix of a row that is proven to have one member, under its
    parent's depth and digest. TAIL: those after it, nodes as they are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(table)  # SKETCH_ROWS x SKETCH_MOST bytes at most
    schema = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in ("conv_id", "depth", "d1", "d2", "p1", "p2", "chars", "before")), ("is_end", pa.bool_())])

    def screen(batches):
        table = shared.value
        for batch in batches:
            flat = unpacked(batch)
            places = sketch_places(flat, table.shape[1])
            estimate = np.min([table[r, p] for r, p in enumerate(places)], axis=0)
            row, at = flat["row"], flat["at"]
            inside = np.arange(len(at)) - flat["starts"][row]
            first = np.full(batch.num_rows, np.iinfo(np.int64).max)
            single = (estimate == 1) & (at > 0)
            np.minimum.at(first, row[single], inside[single])
            kind = np.where(inside < first[row], MEMBER, np.where(inside == first[row], HEAD, TAIL))
            head = kind == HEAD
            is_end = at == np.asarray(batch.column(1))[row]
            columns = [kind, np.asarray(batch.column(0))[row], at - head, np.where(head, flat["p1"], flat["d1"]), np.where(head, flat["p2"], flat["d2"]),
                       flat["p1"], flat["p2"], flat["chars"], flat["before"], is_end]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    kinds = ", ".join(f"{c} bigint" for c in schema.names[1:-1])
    return landed(rows.mapInArrow(screen, f"kind int, {kinds}, is_end boolean"), "trie-screened")


def end_hashes(ends: DataFrame) -> DataFrame:
    """depth, d1, d2, ends_sha256 over ``ends`` (depth, d1, d2, conv_id): the SHA-256 of each node's ids, ascending, comma-joined.

    Sorted tasks first join runs of ids into texts; a node's texts then pass through one hash, never held together.
    """
    schema = pa.schema([("depth", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("least", pa.int64()), ("ids", pa.string())])

    def join(batches):
        now, held = None, []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, held[0], ",".join(map(str, held))), schema, strict=True)], schema=schema)

        for batch in batches:
            for *node, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (node != now or len(held) >= 8_000):
                    yield emit()
                    held = []
                now = node
                held.append(conv)
        if held:
            yield emit()

    def digest(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != now:
                    if state is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in now), pa.array([state.hexdigest()])], names=[*NODE, "ends_sha256"])

    key = ["d1", "d2", "depth"]
    runs = ends.select(*NODE, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(join, "depth bigint, d1 bigint, d2 bigint, least bigint, ids string")
    return runs.repartition(*key).sortWithinPartitions(*key, "least").mapInArrow(digest, "depth bigint, d1 bigint, d2 bigint, ends_sha256 string")


def prefix_trie(steps: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``steps`` has conv_id, last (its number of turns), at (their places from 1 on, and one row at 0 for each conversation),
    one, other (two hashes of the turn), chars. conv_id is the smallest member. Without conversations there is no node, not
    even the root.
    """
    rows = packed(steps)
    turns = rows.agg(F.sum(F.size("turns")).alias("n")).first()["n"] or 0
    width = SKETCH_LEAST
    while width < min(SKETCH_MOST, 4 * turns):
        width *= 2
    found = screened(rows, count_min(rows, width))

    members, heads = found.where(F.col("kind") == MEMBER), found.where(F.col("kind") == HEAD)
    nodes = landed(members.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.first("p1").alias("p1"), F.first("p2").alias("p2")), "trie-nodes")
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).groupBy(*NODE).agg(F.count("*").alias("children"))
    below = below.unionByName(heads.groupBy(*NODE).agg(F.count("*").alias("children"))).groupBy(*NODE).agg(F.sum("children").alias("children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("owner").alias("above"))
    nodes = nodes.join(below, NODE, "left").join(parents, ["depth", "p1", "p2"], "left").select(
        *NODE, "owner", "n_convs", F.coalesce("children", F.lit(0)).alias("n_children"), F.when(F.col("depth") > 0, F.coalesce("above", "owner")).alias("above"))
    nodes = landed(nodes, "trie-nodes")

    placed = landed(found.where(F.col("kind") != TAIL).join(nodes.select(*NODE, "owner", "n_children"), NODE, "left"), "trie-placed")
    own = F.col("owner") == F.col("conv_id")
    facts = placed.where(F.col("kind") == MEMBER).select(
        "conv_id", F.when(~own, F.col("before") + F.col("chars")).otherwise(0).alias("borrowed"), F.when(F.col("is_end") & own & (F.col("n_children") == 0), 1).otherwise(0).alias("leaf"))
    lone = found.where((F.col("kind") != MEMBER) & F.col("is_end")).select("conv_id", F.lit(0).cast("bigint").alias("borrowed"), F.lit(1).alias("leaf"))
    facts = landed(facts.unionByName(lone).groupBy("conv_id").agg(F.max("borrowed").alias("borrowed"), F.max("leaf").cast("bigint").alias("leaf")), "trie-facts")
    sums = placed.where(F.col("kind") == MEMBER).select(*NODE, "conv_id", "before").join(facts, "conv_id").groupBy(*NODE).agg(
        F.sum(F.greatest(F.col("borrowed") - F.col("before"), F.lit(0))).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    ends = end_hashes(members.where("is_end"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    shared = nodes.join(sums, NODE).join(ends, NODE, "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))

    def alone(df: DataFrame, depth, parent) -> DataFrame:
        number = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return df.select("conv_id", depth.alias("depth"), parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(F.col("is_end"), zero).otherwise(one).alias("n_children"),
                         one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("is_end"), number).otherwise(none).alias("ends_sha256"))

    tails = alone(found.where(F.col("kind") == TAIL), F.col("depth"), F.col("conv_id"))
    firsts = alone(placed.where(F.col("kind") == HEAD), F.col("depth") + 1, F.coalesce("owner", "conv_id"))
    return shared.unionByName(firsts).unionByName(tails)


SQL = r"""
WITH ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, count(*) AS own, c - c % 100 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda s, x: list_reduce(list_prepend(xor(s, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384::BIGINT) + z)), 4294967295::BIGINT) % 6 AS h
  FROM ordered GROUP BY c
), turns AS (
  SELECT s.c, o.i AS p, o.r, o.t FROM sizes s JOIN ordered o ON o.c = s.b AND o.i <= s.h
  UNION ALL
  SELECT s.c, o.i - s.h + least(s.h, coalesce(base.own, 0)), o.r, o.t FROM sizes s JOIN ordered o ON o.c = s.c AND o.i > s.h LEFT JOIN sizes base ON base.c = s.b
), whole AS (
  SELECT s.c, coalesce(list({'r': r, 't': t} ORDER BY p) FILTER (WHERE p IS NOT NULL), []) AS path FROM sizes s LEFT JOIN turns USING (c) GROUP BY s.c
), members AS (
  SELECT c, d, path[1:d] AS node, len(path) = d AS is_end FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE is_end), '') AS ends FROM members GROUP BY node, d
), children AS (
  SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), joined AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.node = n.node
), subtree AS (
  SELECT a.node, a.d, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(CASE WHEN b.d = 0 THEN 0 ELSE (b.n_convs - 1) * length(b.node[b.d].t) END) AS saved
  FROM joined a JOIN joined b ON b.d >= a.d AND b.node[1:a.d] = a.node GROUP BY ALL
)
SELECT j.conv_id, j.d AS depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(j.ends) AS ends_sha256
FROM joined j JOIN subtree s ON s.d = j.d AND s.node = j.node LEFT JOIN nodes p ON p.d = j.d - 1 AND p.node = j.node[1:j.d - 1]
"""
