"""Near duplicates by SetSketch registers: banded, estimated jointly by likelihood, then verified on whole sets.

Two documents link when 100 * intersection >= 80 * union of their sets of 4-word shingles.

1. Every distinct set (a class) becomes a sketch. Each shingle throws exponentially distributed points at all
   registers; a register keeps the least of all shingles, which is spaced exponentially and truncated:
   K = clamp(floor(1 - log_b(least)), 0, 255). Registers of a union are the maxima of the registers: mergeable.
2. Bands of registers are hashed. At a similarity of 0.8 two sets miss each other on all bands with a
   probability of about 5e-8. Buckets of the same members are kept once.
3. Inside a bucket the similarity of two sets is estimated jointly from the registers that are greater in the one, in the
   other, and equal, given both sizes. Pairs for which 0.8 and more is far less likely than the best estimate are
   discarded; what is left joins into groups, so that accidental agreements do not chain documents together.
4. Inside a group, each set is read once and links are verified exactly. Links make components.

Buckets and groups of any size are worked on in tiles of bounded rows: first strips, each with some pivots of the whole
group; then only rows that strips and pivots have not joined with the largest part meet all others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import kept, landed, raw
from assayer.llm.components import components
from assayer.llm.jaccard import WordHashes, class_id, mixed, shingles

WORDS, PERCENT = 4, 80
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE = 1.1  # 255 steps of a tenth: least values from about 2 down to 6e-11, sets of up to some 10^9 shingles
UNLIKELY = 14.0  # a pair goes if its likelihood at the bound is below e^-14 of the greatest one
TILE_ROWS, TILE_BYTES, PIVOTS = 2_000, 64 << 20, 16
POINTS = 4  # points drawn at a time
SLICE_BYTES = 2 << 20
_U = np.uint64


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of several sets of hashes, none empty, as rows of uint8.

    A shingle's points are a Poisson process of rate REGISTERS whose points fall on registers at random: its first
    points on the registers are independent exponential values. Points are drawn in rising order, until none that
    is left can be less than a register's value.
    """
    sizes = np.array([len(s) for s in sets])
    least = np.full(len(sets) * REGISTERS, np.inf)
    seed = np.concatenate(sets).astype(np.uint64)
    own = np.repeat(np.arange(len(sets)), sizes)
    at = np.zeros(len(seed))
    step = 0
    while len(seed):
        for _ in range(POINTS if step else 1):
            step += 1
            drawn = mixed(seed + _U(step * 0x9E3779B97F4A7C15 % (1 << 64)))
            at -= np.log(((drawn >> _U(12)).astype(np.float64) + 0.5) / 2.0**52) / REGISTERS
            np.minimum.at(least, own * REGISTERS + (drawn & _U(REGISTERS - 1)).astype(np.int64), at)
        open_ = at < least.reshape(len(sets), REGISTERS).max(axis=1)[own]
        seed, own, at = seed[open_], own[open_], at[open_]
    registers = np.floor(1 - np.log(least / 2.0) / math.log(BASE))
    return np.clip(registers, 0, 255).astype(np.uint8).reshape(len(sets), REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash for each band of each row."""
    bands = np.ascontiguousarray(registers.reshape(len(registers), BANDS, ROWS)).view(np.uint32).reshape(len(registers), BANDS).astype(np.uint64)
    return mixed(mixed(bands + _U(1)) + np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _greater(x: np.ndarray) -> np.ndarray:
    """The probability that a register is greater in a set whose share of the union is its own alone by ``x``."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def log_likelihood(similarity: np.ndarray, one: np.ndarray, other: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of ``similarity``, given the sizes of two sets and the numbers of registers greater in the first and in the second."""
    u, v = one / (one + other), other / (one + other)
    p = np.clip(_greater(u - v * similarity), 1e-12, 1)
    q = np.clip(_greater(v - u * similarity), 1e-12, 1)
    return first * np.log(p) + second * np.log(q) + (REGISTERS - first - second) * np.log(np.clip(1 - p - q, 1e-12, 1))


def plausible(one: np.ndarray, other: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether a similarity of ``percent`` or more is not far less likely than the likeliest of all."""
    bound, most = percent / 100, np.minimum(one, other) / np.maximum(one, other)
    grid = np.linspace(0, 1, 41)[:, None]
    everywhere = log_likelihood(grid * most, one, other, first, second).max(axis=0)
    above = log_likelihood(bound + grid[::4] * np.maximum(most - bound, 0), one, other, first, second).max(axis=0)
    return (most >= bound - 1e-12) & (above >= everywhere - UNLIKELY)


class Tile:
    """Rows of one bucket or group: nodes, set sizes, registers, and sets where links are to be verified."""

    def __init__(self, nodes: list[int], sizes: list[int], registers: list[bytes], sets: list[bytes] | None, percent: int):
        order = np.argsort(np.array(sizes), kind="stable")
        self.nodes, self.sizes = np.array(nodes, dtype=np.int64)[order], np.array(sizes, dtype=np.int64)[order]
        self.registers = np.frombuffer(b"".join(registers), dtype=np.uint8).reshape(-1, REGISTERS)[order]
        self.sets = None if sets is None else [np.frombuffer(sets[i], dtype=np.uint64) for i in order]
        self.percent = percent

    def linked(self, x: int, y: int) -> bool:
        if self.sets is None:
            return True
        one, other = self.sets[x], self.sets[y]
        if len(one) > len(other):
            one, other = other, one
        shared = int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())
        return 100 * shared >= self.percent * (len(one) + len(other) - shared)

    def edges(self, group: np.ndarray, asks: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Edges that join all linked rows. Rows of one ``group`` hang together already; if ``asks`` is given,
        only pairs with a row that asks are looked at."""
        found = []
        group = group.copy()
        for x in range(1, len(self.nodes)):
            low = int(np.searchsorted(self.sizes, -(-self.percent * self.sizes[x] // 100)))
            rows = np.arange(low, x)
            rows = rows[group[rows] != group[x]]
            if asks is not None and not asks[x]:
                rows = rows[asks[rows]]
            if not len(rows):
                continue
            mine, theirs = self.registers[x], self.registers[rows]
            first, second = (theirs < mine).sum(axis=1), (theirs > mine).sum(axis=1)
            near = plausible(self.sizes[x], self.sizes[rows], first, second, self.percent)
            rows = rows[near][np.argsort((first + second)[near], kind="stable")]  # the likeliest first
            for y in rows:
                if group[y] != group[x] and self.linked(x, int(y)):
                    found.append((int(self.nodes[x]), int(self.nodes[y])))
                    group[group == group[y]] = group[x]
        return found


def tile_edges(rows: DataFrame, keys: list[str], percent: int, sets: bool) -> DataFrame:
    """a, b: the edges of every tile of ``rows`` (``keys``, node, label, asks, size, registers, found)."""

    def work(batches):
        held: dict[int, tuple] = {}
        now = None

        def edges():
            if len(held) < 2:
                return []
            nodes, labels, asks, sizes, registers, found = zip(*held.values(), strict=True)
            tile = Tile(list(nodes), list(sizes), list(registers), list(found) if sets else None, percent)
            place = {node: i for i, node in enumerate(nodes)}
            order = [place[int(n)] for n in tile.nodes]
            group = np.unique(np.array(labels, dtype=np.int64)[order], return_inverse=True)[1]
            return tile.edges(group, np.array(asks, dtype=bool)[order])

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[: len(keys)] != now:
                    out += edges()
                    now, held = row[: len(keys)], {}
                values = row[len(keys) :]
                if values[0] not in held or values[2]:  # a pivot can come twice
                    held[values[0]] = values
            yield batch_of(out)
        yield batch_of(edges())

    columns = [*keys, "node", "label", "asks", "size", "registers", "found"]
    return rows.select(*columns).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(work, "a bigint, b bigint")


def joined(members: DataFrame, content: DataFrame, percent: int, sets: bool) -> DataFrame:
    """a, b: edges that join all rows of a group that are linked, for every group of ``members`` (group, node).

    ``content`` has node, size, registers, found. A large group is cut into strips; each strip also gets the group's
    pivots. Then the rows that are not in the part of most rows of their group meet all rows of it, strip by strip.
    Each row travels once for its strip and once for the second round; only rows still on their own are copied.
    """
    weight = F.lit(REGISTERS) + (F.coalesce(F.length("found"), F.lit(0)) if sets else 0)
    sized = landed(members.join(content.select("node", weight.cast("bigint").alias("bytes")), "node"), "sketch-sized")
    counted = sized.groupBy("group").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).where("rows > 1")
    strips = F.greatest(F.ceil(F.col("rows") / TILE_ROWS), F.ceil(F.col("bytes") / TILE_BYTES))
    counted = landed(counted.select("group", "rows", strips.cast("int").alias("strips")), "sketch-groups")
    cut = sized.drop("bytes").join(counted, "group").withColumn("strip", F.pmod(F.xxhash64("node"), F.col("strips")).cast("int"))
    is_pivot = (F.col("strips") > 1) & (F.pmod(F.xxhash64("node", F.lit(7)), F.col("rows")) < PIVOTS)
    everywhere = F.when(is_pivot, F.sequence(F.lit(0), F.col("strips") - 1)).otherwise(F.array("strip"))
    tiles = cut.withColumn("strip", F.explode(everywhere)).join(content, "node")
    first = landed(tile_edges(tiles.withColumns({"label": F.col("node"), "asks": F.lit(True)}), ["group", "strip"], percent, sets), "sketch-edges")
    large = landed(cut.where("strips > 1"), "sketch-large")
    if large.isEmpty():
        return first

    labels = landed(components(first), "sketch-labels").withColumnRenamed("node", "of")
    labelled = landed(large.join(labels, F.col("node") == F.col("of"), "left").withColumn("label", F.coalesce("label", "node")).drop("of"), "sketch-labelled")
    parts = labelled.groupBy("group", "label").agg(F.count("*").alias("held"))
    most = parts.groupBy("group").agg(F.max_by("label", F.struct("held", "label")).alias("most"))
    marked = landed(labelled.join(most, "group").withColumn("asks", F.col("label") != F.col("most")).drop("most"), "sketch-marked")
    open_rows = marked.where("asks").groupBy("group").agg(F.count("*").alias("open"))
    again = marked.join(open_rows, "group").withColumn("parts", F.ceil(F.col("open") / TILE_ROWS).cast("int"))
    part = F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts")).cast("int")
    # every row goes with its strip to each part of the asking rows, which are fewer; asking rows go to all strips of their part
    rows = again.withColumn("asks", F.lit(False)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asking = again.where("asks").withColumn("part", part).withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    columns = ["group", "strip", "part", "node", "label", "asks"]
    second = tile_edges(rows.select(*columns).unionByName(asking.select(*columns)).join(content, "node"), ["group", "strip", "part"], percent, sets)
    return landed(first.unionByName(second), "sketch-edges")


def slices(batch: pa.RecordBatch, texts: int):
    """Parts of a batch whose texts, in column ``texts``, have some SLICE_BYTES."""
    upto = np.cumsum([len(t) for t in batch.column(texts).to_pylist()]) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def sketch_texts(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, node (the number of its set), n (shingles), registers (once for each set a task meets) of every row of ``docs``."""

    def prepare(batches):
        hashes, done = kept("word hashes", WordHashes), set()
        for batch in batches:
            for part in slices(batch, 1):
                sets = [shingles(text, hashes, size) for text in part.column(1).to_pylist()]
                nodes = [class_id(s) for s in sets]
                new = [i for i in {n: i for i, n in enumerate(nodes)}.values() if len(sets[i]) and nodes[i] not in done]
                registers: list[bytes | None] = [None] * len(sets)
                if new:
                    for i, row in zip(new, sketches([sets[i] for i in new]), strict=True):
                        registers[i] = row.tobytes()
                    if len(done) < 1_000_000:  # no more is needed than sets met lately
                        done.update(nodes[i] for i in new)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(registers, pa.binary())], names=["doc_id", "node", "n", "registers"])

    return docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).mapInArrow(prepare, "doc_id bigint, node bigint, n bigint, registers binary")


def buckets_of(classes: DataFrame) -> DataFrame:
    """group, node: the members of every band's buckets of two classes and more; buckets of the same members once."""

    def emit(batches):
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)
            keys = band_keys(registers).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(np.asarray(batch.column(0)), BANDS))], names=["key", "node"])

    keys = landed(classes.select("node", "registers").mapInArrow(emit, "key bigint, node bigint"), "sketch-keys")
    mark = F.shiftrightunsigned(F.xxhash64("node"), 28)  # sums of 2^27 of these fit
    counted = keys.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("least"), F.max("node").alias("most"), F.sum(mark).alias("sum"), F.bit_xor(F.xxhash64("node", F.lit(5))).alias("mix")).where("rows > 1")
    once = landed(counted.groupBy("rows", "least", "most", "sum", "mix").agg(F.min("key").alias("key")).select("key"), "sketch-buckets")
    return keys.join(once, "key").select(F.col("key").alias("group"), "node")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, size, registers, found: the whole sets of the classes in ``wanted`` (doc_id, node, size, registers), read again from one
    document each."""

    def read(batches):
        hashes = kept("word hashes", WordHashes)
        for batch in batches:
            for part in slices(batch, 0):
                sets = [shingles(text, hashes, size) for text in part.column(0).to_pylist()]
                same = [class_id(s) == n for s, n in zip(sets, part.column(1).to_pylist(), strict=True)]  # else a document that shares the id
                columns = [*part.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "registers", "found"]).filter(pa.array(same, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).join(wanted.hint("shuffle_hash"), "doc_id")
    rows = texts.select("text", "node", "size", "registers").mapInArrow(read, "node bigint, size bigint, registers binary, found binary")
    rows = landed(rows, "sketch-sets")
    if rows.count() > wanted.count():  # equal rows
        rows = landed(rows.dropDuplicates(["node"]), "sketch-sets")
    return rows


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach, the own one included; ``kept`` says whether that is the
    row's own. Texts without a word, null among them, have no shingles and link with nothing, equal ones neither.
    Rows that repeat an id are looked at each on its own. Rows without an id are linked where an equal text has an
    id; other rows without one have no component and are kept, since nothing says which one stays. An empty
    table gives no rows.
    """
    rows = landed(sketch_texts(docs, size), "sketch-rows")
    classes = rows.where("registers is not null").groupBy("node").agg(F.max("n").alias("size"), F.first("registers").alias("registers"), F.min("doc_id").alias("doc_id"))
    classes = landed(classes, "sketch-classes")
    content = classes.select("node", "size", "registers", F.lit(None).cast("binary").alias("found"))
    near = joined(buckets_of(classes), content, percent, sets=False)
    groups = landed(components(near).select(F.col("label").alias("group"), "node"), "sketch-near")
    wanted = landed(groups.select("node").join(classes, "node").where("doc_id is not null").select("doc_id", "node", "size", "registers"), "sketch-wanted")
    content = sets_of(docs, wanted, size)
    labels = landed(components(joined(groups, content, percent, sets=True)), "sketch-links")
    labelled = rows.where("n > 0").select("doc_id", "node", "n").join(labels, "node", "left").select("doc_id", "n", F.coalesce("label", "node").alias("label"))
    labelled = landed(labelled, "sketch-labelled")
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = labelled.join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reached r JOIN both_ways e ON r.y = e.x
), least AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
