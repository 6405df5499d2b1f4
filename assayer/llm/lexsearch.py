"""Ranked lexical search: dense blocked products of item weights and document impacts.

A term's weight is w = floor(1000 * ln((2N + 2) / (2df + 1))), its impact on a document of tf occurrences is
(1000000000 * tf) div (1000 * tf + 8m), with m = 25 + ((75 * n * N) div L). A score is the sum of weight times
impact over the terms of an item, repeats included.

1. Items are read in blocks of a bounded number of terms; each block has a compact vocabulary of its own.
2. One scan of all texts per block: each document becomes its length and its occurrences of that vocabulary. What
   is left is some bytes per document; frequencies and totals are aggregates of it.
3. Product: tiles of documents as dense matrices of impacts, over the terms that the tile holds, times the dense
   matrix of weights, in float64 BLAS. Impacts are whole numbers below 10^6, so columns are cut into runs whose
   weights add up to less than 2^53 / 10^6 for every item: all sums are whole numbers that a double holds exactly.
   Runs add up as 64-bit integers.
4. Each tile keeps an item's k best, by score and then doc_id, so that ties at its edge are settled for good;
   tasks merge their tiles, and two rounds of windows merge the tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import UPPER, landed, raw

BEST = 10
BLOCK_TERMS, BLOCK_ITEMS = 8_000, 500
TILE_CELLS = 1_500_000
MOST_IMPACT = 1_000_000
SALTS = 64

# Bytes that end a term become spaces; A-Z become a-z.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
FOLD = bytes.maketrans(SEPARATORS + UPPER.encode(), b" " * len(SEPARATORS) + UPPER.lower().encode())


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def blocks_of(items: DataFrame, block_terms: int) -> DataFrame:
    """item_key, item_id, block, found (its terms joined by spaces) of the items with a term.

    A block has about ``block_terms`` terms and BLOCK_ITEMS items at most; an item of many terms is one of its own.
    """

    def read(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            split = [terms(t) for t in texts]
            kept = [(i, b" ".join(s), len(s)) for i, s in zip(ids, split, strict=True) if s]
            columns = list(zip(*kept, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], names=["item_id", "found", "n"])

    kind = items.schema["item_id"].dataType.simpleString()
    split = items.select("item_id", raw().alias("text")).mapInArrow(read, f"item_id {kind}, found binary, n bigint")
    split = landed(split.withColumn("item_key", F.monotonically_increasing_id()), "search-items")
    total = split.agg(F.sum("n").alias("n"), F.count("*").alias("items")).first()
    blocks = max(1, -(-(total["n"] or 0) // block_terms), -(-total["items"] // BLOCK_ITEMS))
    alone = F.when(F.col("n") > block_terms // 4, -1 - F.col("item_key"))
    return split.withColumn("block", F.coalesce(alone, F.pmod(F.xxhash64("item_key"), F.lit(blocks))))


def incidence(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the whole text), at, tf (packed numbers of the vocabulary's terms and their occurrences)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block

    def read(batches):
        numbers = shared.value
        for batch in batches:
            lengths, at, tf = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                found = np.array([x for x in map(numbers.get, words) if x is not None], dtype=np.int32)
                which, times = np.unique(found, return_counts=True)
                lengths.append(len(words))
                at.append(which.astype(np.int32).tobytes())
                tf.append(times.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(at, pa.binary()), pa.array(tf, pa.binary())], names=["doc_id", "n", "at", "tf"])

    return docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).mapInArrow(read, "doc_id bigint, n bigint, at binary, tf binary")


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """The number of documents of each term of a vocabulary of ``size``."""

    def count(batches):
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int32)
            df += np.bincount(held, minlength=size)
        present = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(present, pa.int64()), pa.array(df[present], pa.int64())], names=["term", "df"])

    df = np.zeros(size, dtype=np.int64)
    for row in found.select("at").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[row["term"]] = row["df"]
    return df


def runs_below(most: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Consecutive columns, cut so that the greatest weights of each run add up to ``limit`` at most."""
    runs, start, total = [], 0, 0
    for i, weight in enumerate(most):
        if i > start and total + weight > limit:
            runs.append((start, i))
            start, total = i, 0
        total += weight
    return [*runs, (start, len(most))] if len(most) else []


def product(impacts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The exact int64 product of whole numbers held as float64; impacts are below MOST_IMPACT."""
    scores = np.zeros((impacts.shape[0], weights.shape[1]), dtype=np.int64)
    most, limit = weights.max(axis=1, initial=0), 2**53 / MOST_IMPACT
    for start, end in runs_below(most, limit):
        if most[start:end].max() > limit:  # one term, very often in one item
            scores += impacts[:, start:end].astype(np.int64) @ weights[start:end].astype(np.int64)
        else:
            scores += (impacts[:, start:end] @ weights[start:end]).astype(np.int64)
    return scores


def best_of(keys: np.ndarray, scores: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one item's (keys, scores) the ``best`` with a score above 0: highest score first, then least key."""
    if len(scores) > best:
        edge = np.partition(scores, len(scores) - best)[len(scores) - best]
        keep = scores >= max(int(edge), 1)  # all that tie at the edge
        keys, scores = keys[keep], scores[keep]
    else:
        keys, scores = keys[scores > 0], scores[scores > 0]
    order = np.lexsort((keys, -scores))[:best]
    return keys[order], scores[order]


def search_block(found: DataFrame, items: list[dict[int, int]], weight: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """item (its number in ``items``), doc_id, score: what each task holds among each item's best."""
    weights = np.zeros((len(weight), len(items)))
    for column, item in enumerate(items):
        for term, times in item.items():
            weights[term, column] = weight[term] * times
    shared = found.sparkSession.sparkContext.broadcast(weights)  # terms x items of one block
    nothing = np.iinfo(np.int64).max  # rows without an id come last; the id itself may be that number

    def multiply(batches):
        weights = shared.value
        tops = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * weights.shape[1]
        missing = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * weights.shape[1]
        rows = max(16, TILE_CELLS // max(1, len(weights)))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                known = ~np.asarray(part.column(0).is_null())
                ids = np.asarray(part.column(0).fill_null(nothing))
                held = part.column(2).to_pylist()
                at = np.frombuffer(b"".join(held), dtype=np.int32)
                if not len(at):
                    continue
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.int32).astype(np.int64)
                row = np.repeat(np.arange(len(held)), [len(x) // 4 for x in held])
                m = 25 + np.array([75 * n * n_docs // n_terms for n in part.column(1).to_pylist()], dtype=np.int64)
                columns, place = np.unique(at, return_inverse=True)
                impacts = np.zeros((len(held), len(columns)))
                impacts[row, place] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
                scores = product(impacts, weights[columns])
                for lists, which in ((tops, known), (missing, ~known)):
                    if which.any():
                        for item in range(scores.shape[1]):
                            one = scores[which, item]
                            floor = lists[item][1][-1] if len(lists[item][1]) >= best else 1
                            near = np.flatnonzero(one >= floor)
                            if len(near):
                                lists[item] = best_of(np.concatenate((lists[item][0], ids[which][near])), np.concatenate((lists[item][1], one[near])), best)
        for lists, is_null in ((tops, False), (missing, True)):
            numbers = np.concatenate([np.full(len(k), i) for i, (k, _) in enumerate(lists)] or [np.zeros(0)])
            keys = np.concatenate([k for k, _ in lists] or [np.zeros(0, dtype=np.int64)])
            scores = np.concatenate([s for _, s in lists] or [np.zeros(0, dtype=np.int64)])
            ids = pa.nulls(len(keys), pa.int64()) if is_null else pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), ids, pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return found.mapInArrow(multiply, "item int, doc_id bigint, score bigint")


def ranked(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` of each item_key over all tasks, with their rank."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item_key", "salt").orderBy(*order)
    few = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= best)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item_key").orderBy(*order))).where(F.col("rank") <= best).drop("salt")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``best`` documents of ``docs`` (doc_id, text) by score.

    Every row of ``items`` (item_id, text) is searched for on its own, rows that repeat an id or have none
    among them; an item without a term, null text included, finds nothing. Every row of ``docs`` is a document, so
    equal rows come side by side; null and empty texts have no terms and are never found. Equal scores come by
    ascending doc_id, rows without an id last. Empty tables give no rows.
    """
    spark = docs.sparkSession
    split = landed(blocks_of(items, block_terms), "search-blocks")
    numbers = sorted(r["block"] for r in split.select("block").distinct().toLocalIterator())
    parts, n_docs, n_terms = [], 0, 0
    for number in numbers:
        rows = [(r["item_key"], bytes(r["found"]).split()) for r in split.where(F.col("block") == number).orderBy("item_key").toLocalIterator()]
        vocabulary: dict[bytes, int] = {}
        counted = []
        for _, words in rows:
            counted.append({})
            for word in words:
                at = vocabulary.setdefault(word, len(vocabulary))
                counted[-1][at] = counted[-1].get(at, 0) + 1
        found = landed(incidence(docs, vocabulary), "search-incidence")
        if not n_docs:
            totals = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
            n_docs, n_terms = totals["docs"], totals["terms"]
            if not n_docs:
                break
        df = document_frequencies(found, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.float64)
        held = found.where(F.length("at") > 0)
        keys = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(rows)], "item int, item_key bigint")
        parts.append(landed(search_block(held, counted, weight, n_docs, n_terms, best).join(F.broadcast(keys), "item").drop("item"), "search-found"))
    if not parts:
        return split.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).where("false")
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return ranked(everything, best).join(split.select("item_key", "item_id"), "item_key").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), occurrences AS (
  SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf) AS n FROM occurrences GROUP BY ALL
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM occurrences, totals GROUP BY term, docs
), normal AS (
  SELECT doc_id, 100 - 75 + ((75 * n * docs) // all_terms) AS m FROM lengths, totals
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN occurrences USING (term) JOIN normal USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
