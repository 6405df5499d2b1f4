"""Exact n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Two documents link when 100 * intersection >= 85 * union of their sets of 4-word shingles.

1. Documents become sorted sets of shingle hashes; equal sets are one class.
2. Blocks: linked sets of the sizes of one level differ in at most d shingles, a bound that follows from the
   sizes. The range of the hashes is cut into more than d strips, so linked sets agree on one of the
   first d + 1 strips that hold anything. Strips are cut of shingles that are not very frequent, or texts
   that share a common passage would agree on it. Classes that agree on a strip go into one block; agreement is kept
   as one edge from each class to the least one, so a block's table grows with its classes, not their pairs.
   Blocks hold every linked pair, and little else, since a strip holds several shingles.
3. Product: within a block, overlaps of rows are accumulated over the columns they share, and pairs below the
   bound that their sizes demand are discarded. Large blocks are tiled, and each tile is a task's work.
4. Links make components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import kept, landed, raw
from assayer.llm.components import components

WORDS, PERCENT = 4, 85
TILE_ROWS, TILE_SHINGLES = 2_000, 4_000_000
MOST_FREQUENT = 200_000
KNOWN_WORDS = 500_000
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def shingles(text: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles; of all its words if there are fewer; empty without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(h))
    x = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        x = mixed(x * _U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def class_id(found: np.ndarray) -> int:
    """A 64-bit number of a set of shingles."""
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)


def levels(most: int, percent: int = PERCENT) -> np.ndarray:
    """Bounds of the size levels: two linked sets lie in one level or in neighbouring ones."""
    bounds = [1]
    while len(bounds) < 4 or bounds[-3] <= most:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds)


def strip_marks(found: np.ndarray, bounds: np.ndarray, percent: int = PERCENT, frequent: np.ndarray | None = None) -> np.ndarray:
    """Marks of the strips on which linked sets must agree once: of the own level and of the one below.

    Strips are cut of the shingles that are not ``frequent`` (sorted), whatever these are: linked sets differ in
    no more of those than of all. A set with too few of them gives marks of all its shingles, too.
    """
    rare = found
    if frequent is not None and len(frequent):
        rare = found[frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] != found]
    level = int(np.searchsorted(bounds, len(found), side="right")) - 1
    marks = []
    for k in (level, level - 1):
        # no two linked sets of levels k and k + 1 differ in more shingles than this
        d = int((bounds[k + 1] - 1 + bounds[k + 2] - 1) * (100 - percent) // (100 + percent)) if k >= 0 else 0
        if d == 0:  # only equal sets are linked
            continue
        strips = d * 5 // 4 + 1
        for part, which in ((rare, 0), (found, 1)):
            strip = ((part >> _U(32)) * _U(strips)) >> _U(32)
            starts = np.flatnonzero(np.concatenate(([True], strip[1:] != strip[:-1]))) if len(part) else np.zeros(0, dtype=np.int64)
            if len(starts):
                marks.append(mixed(np.add.reduceat(mixed(part), starts)[: d + 1] + strip[starts[: d + 1]] * _U(7919) + _U((2 * k + which) << 48)))
            if len(starts) > d:
                break
        else:  # a set that fills fewer than d + 1 strips has given all it has, and gives one mark for being so
            marks.append(mixed(np.array([k], dtype=np.uint64)))
    return np.concatenate(marks) if marks else np.zeros(0, dtype=np.uint64)


def frequent_shingles(docs: DataFrame, size: int, most: int = MOST_FREQUENT) -> np.ndarray:
    """At most ``most`` shingles that very many different texts hold, sorted.

    Each task counts all its shingles and passes on those it met twice or more; the least count, a power of
    two from 16 on, is the first that leaves no more than ``most``. Which these are has no influence on the
    links, only on how well blocks are told apart.
    """

    def count(batches):
        hashes = kept("word hashes", WordHashes)
        parts, filled, done = [], 0, set()

        def emit():
            found, n = np.unique(np.concatenate([*parts, np.zeros(0, dtype=np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1], pa.int64())], names=["shingle", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                mark = xxhash.xxh64_intdigest(text)
                if mark not in done:
                    done.add(mark)
                    parts.append(shingles(text, hashes, size))
                    filled += len(parts[-1])
                if filled > 4_000_000:
                    yield emit()
                    parts, filled, done = [], 0, set()
        yield emit()

    counts = docs.select(raw().alias("text")).mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).where("n >= 16")
    counts = landed(counts, "frequent-shingles")
    sizes = {r["power"]: r["n"] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}
    least, total = max(sizes, default=4) + 1, 0
    while least > 4 and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    rows = counts.where(F.floor(F.log2("n")) >= least).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64))


def least_of_marks(marks: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct marks, the least node of each, edges from the other nodes to it)"""
    order = np.lexsort((nodes, marks))
    marks, nodes = marks[order], nodes[order]
    starts = np.flatnonzero(np.concatenate(([True], marks[1:] != marks[:-1]))) if len(marks) else np.zeros(0, dtype=int)
    least = np.repeat(nodes[starts], np.diff(np.append(starts, len(marks))))
    other = nodes != least
    edges = np.unique(np.stack([nodes[other], least[other]], axis=1), axis=0)
    return marks[starts], nodes[starts], edges


PART = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
SET, EDGE, MARKS = 0, 1, 2


def sets_and_edges(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """kind SET: a = doc_id, b = class, n = set size of every row; kind EDGE: a, b = classes that agree on a strip.

    Each task first keeps the least class of every mark it met, so that a mark of very many documents is sent
    once by each task. Marks travel packed, some thousand to a row.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, size))  # MOST_FREQUENT numbers at most

    def prepare(batches):
        often = frequent.value
        hashes, bounds = kept("word hashes", WordHashes), levels(1 << 40, percent)
        marks, nodes, done = [], [], {}

        def emit():
            found, least, edges = least_of_marks(np.concatenate([*marks, np.zeros(0, dtype=np.uint64)]), np.concatenate([*nodes, np.zeros(0, dtype=np.int64)]))
            bucket = (mixed(found) % _U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, found, least = bucket[order], found[order], least[order]
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, dtype=int)
            ends = np.append(starts, len(bucket))[1:]
            packed = [found[s:e].tobytes() + least[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
            rows = len(edges) + len(packed)
            own = np.concatenate((np.abs(edges[:, 0] % buckets).astype(np.int32), bucket[starts]))
            nothing = [None] * len(packed)
            yield pa.RecordBatch.from_arrays([
                pa.array(own, pa.int32()), pa.array([EDGE] * len(edges) + [MARKS] * len(packed), pa.int32()), pa.array([*edges[:, 0].tolist(), *nothing], pa.int64()),
                pa.array([*edges[:, 1].tolist(), *nothing], pa.int64()), pa.nulls(rows, pa.int64()), pa.array([None] * len(edges) + packed, pa.binary()),
            ], schema=PART)

        size_now = 0
        for batch in batches:
            ids, classes, sizes = batch.column(0), [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, hashes, size)
                number = class_id(found)
                classes.append(number)
                sizes.append(len(found))
                if len(found) and number not in done:
                    done[number] = True
                    marks.append(strip_marks(found, bounds, percent, often))
                    nodes.append(np.full(len(marks[-1]), number, dtype=np.int64))
                    size_now += len(marks[-1])
            own = np.arange(len(classes), dtype=np.int32) % buckets  # anywhere: equal sets need not meet here
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([SET] * len(own), pa.int32()), ids, pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(own), pa.binary())], schema=PART)
            if size_now > 3_000_000:
                yield from emit()
                marks, nodes, done, size_now = [], [], {}, 0
        yield from emit()

    def join(rows: pa.Table) -> pa.Table:
        kind = np.asarray(rows["kind"])
        packed = [np.frombuffer(d, dtype=np.uint64) for d in rows["data"].filter(pa.array(kind == MARKS)).to_pylist()]
        marks = np.concatenate([*(p[: len(p) // 2] for p in packed), np.zeros(0, dtype=np.uint64)])
        nodes = np.concatenate([*(p[len(p) // 2 :].view(np.int64) for p in packed), np.zeros(0, dtype=np.int64)])
        edges = least_of_marks(marks, nodes)[2]
        made = pa.table([pa.array([EDGE] * len(edges), pa.int32()), pa.array(edges[:, 0], pa.int64()), pa.array(edges[:, 1], pa.int64()), pa.nulls(len(edges), pa.int64())], names=["kind", "a", "b", "n"])
        return pa.concat_tables([rows.filter(pa.array(kind != MARKS)).select(["kind", "a", "b", "n"]), made])

    parts = docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).mapInArrow(prepare, "bucket int, kind int, a bigint, b bigint, n bigint, data binary")
    return landed(parts.groupBy("bucket").applyInArrow(join, "kind int, a bigint, b bigint, n bigint"), "sets-and-edges")


def links_of_tile(numbers: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all linked classes of a tile. ``sides``: 0 and 1 for the two strips of a tile off the diagonal.

    The rows' columns are numbered anew; a row's overlaps with earlier rows are sums over its own columns.
    Rows come by size, so the rows that a size bound leaves are neighbours. Rows that already hang together
    need no further overlap.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, numbers, sides = [sets[i] for i in order], numbers[order], sides[order]
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    columns = np.unique(np.concatenate(sets), return_inverse=True)[1]
    present = np.zeros(int(columns.max()) + 1, dtype=np.int64)
    group = np.arange(len(sets))
    two_sided = len(set(sides.tolist())) > 1
    links = []
    for x in range(1, len(sets)):
        own = columns[starts[x] : starts[x + 1]]
        present[own] = 1
        low = int(np.searchsorted(sizes, -(-percent * sizes[x] // 100)))
        step, high = 16, x
        while high > low:
            rows = np.arange(max(low, high - step), high)
            high, step = int(rows[0]), step * 4
            rows = rows[group[rows] != group[x]]
            if two_sided:
                rows = rows[sides[rows] != sides[x]]
            if not len(rows):
                continue
            held = np.concatenate([columns[starts[r] : starts[r + 1]] for r in rows])
            overlap = np.add.reduceat(present[held], np.concatenate(([0], np.cumsum(sizes[rows])[:-1])))
            for r in rows[100 * overlap >= percent * (sizes[rows] + sizes[x] - overlap)]:
                if group[r] != group[x]:
                    links.append((int(numbers[r]), int(numbers[x])))
                    group[group == group[r]] = group[x]
        present[own] = 0
    return links


def links_in_blocks(docs: DataFrame, classes: DataFrame, blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b: links that join all linked classes of every block.

    ``classes`` has doc_id, class, n; ``blocks`` node, label. Only texts of classes in blocks are read again,
    one document for each class. A block of many rows is tiled: each row goes to as many tiles as there are
    strips of at most TILE_ROWS rows.
    """
    one = classes.join(blocks, F.col("class") == F.col("node")).groupBy("class").agg(F.min("label").alias("block"), F.max("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id")).alias("first"))
    one = landed(one.select("class", "block", "n", F.col("first.doc_id").alias("wanted")), "block-classes")
    strips = one.groupBy("block").agg(F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("strips"))
    wanted = landed(one.join(strips, "block").select("wanted", "class", "block", "strips"), "block-rows").hint("shuffle_hash")
    texts = docs.select("doc_id", raw().alias("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")))

    def read(batches):
        hashes = kept("word hashes", WordHashes)
        for batch in batches:
            out = []
            for text, number, block, strips in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text, hashes, size)
                if class_id(found) == number:  # else another document that has the same id
                    out.append((number, block, strips, found.tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary())], names=["class", "block", "strips", "found"])

    def multiply(batches):
        held: dict[int, tuple[bytes, int]] = {}
        now = None

        def links():
            if len(held) < 2:
                return []
            return links_of_tile(np.array(list(held), dtype=np.int64), [np.frombuffer(f, dtype=np.uint64) for f, _ in held.values()], np.array([s for _, s in held.values()]), percent)

        for batch in batches:
            out = []
            for block, one_strip, other, strip, number, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, one_strip, other) != now:
                    out += links()
                    now, held = (block, one_strip, other), {}
                held[number] = (found, strip)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])
        out = links()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    rows = texts.select("text", "class", "block", "strips").mapInArrow(read, "class bigint, block bigint, strips int, found binary")
    rows = rows.withColumn("strip", F.pmod(F.xxhash64("class"), F.col("strips")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    tiles = rows.select("block", F.least("strip", "with").alias("one"), F.greatest("strip", "with").alias("other"), "strip", "class", "found")
    return tiles.repartition("block", "one", "other").sortWithinPartitions("block", "one", "other").mapInArrow(multiply, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach, the own one included. Texts without a word, null
    among them, have no shingles and link with nothing, equal ones neither. Rows that repeat an id are looked
    at each on its own; a component of rows without ids has none.
    """
    parts = sets_and_edges(docs, size, percent)
    classes = parts.where(F.col("kind") == SET).select(F.col("a").alias("doc_id"), F.col("b").alias("class"), "n")
    blocks = landed(components(parts.where(F.col("kind") == EDGE).select("a", "b")), "blocks")
    links = landed(links_in_blocks(docs, classes.where("n > 0"), blocks, size, percent), "links")
    labels = landed(components(links), "labels")
    labelled = landed(classes.join(labels, F.col("class") == F.col("node"), "left").select("doc_id", "n", F.coalesce("label", "class").alias("label")), "labelled")
    least = landed(labelled.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")), "least-ids")
    found = labelled.where("n > 0").join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    return found.unionByName(labelled.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id, all columns as they are.

    Documents without a word stay, and so do all rows without an id. Rows that repeat an id with other texts are documents of
    their own: of those with the smallest id in a component one stays, the others are judged by their own component. Of rows with
    the same id and text the one stays whose other columns come first as JSON.
    """
    named = docs.withColumn("__key", F.xxhash64("doc_id", "text")).where("doc_id is not null")
    found = jaccard_components(named.select(F.col("__key").alias("doc_id"), "text"), size, percent)
    found = landed(found.withColumnRenamed("doc_id", "__key").distinct(), "components-of-rows")
    ids = named.select("__key", "doc_id").join(found.where("n_shingles > 0"), "__key")
    first = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "__key")).alias("first")).select("first.__key")
    stays = landed(first.unionByName(found.where("n_shingles = 0").select("__key")), "stays").hint("shuffle_hash")
    others = F.to_json(F.struct("doc_id", *(c for c in docs.columns if c not in ("doc_id", "text"))))
    chosen = named.join(stays, "__key", "left_semi").groupBy("__key").agg(F.min_by(F.struct(*docs.columns), others).alias("row")).select("row.*")
    return chosen.unionByName(docs.where("doc_id is null"))


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
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reached r JOIN both_ways e ON r.y = e.x
), least AS (
  SELECT x, min(y) AS component_id FROM reached GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d JOIN least ON x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
