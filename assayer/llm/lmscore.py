"""Language-model scores from log-frequency Bloom filters.

A filter holds quantised counts of n-grams: one whose count has the quantum q is entered q times, as (n-gram, 1)
to (n-gram, q), and its count is read back by probing until a probe fails. Smoothed probabilities come from
these counts.

All pairs of words count. Those that are frequent (at least 1 in HOT_WORDS of all tokens, so at most that many)
and the frequent words are broadcast with their counts. All others are dealt out by hashes to segments, whose
number grows with the texts; each counts its pairs and words, fills a filter of its own, probes it for the texts
and sends the sums back to their rows. No part of the model has to fit one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import held_out, landed, raw

HOT_WORDS = 100_000
SEGMENT_TOKENS = 1_500_000  # in a segment, about
FLUSH_PAIRS, FLUSH_ROWS = 1_000_000, 60_000
BITS_PER_ENTRY, PROBES, SEGMENTS = 10, 4, 64
BASE = 1.5  # of the logarithm that quantises counts
KNOWN_WORDS = 300_000
_U = np.uint64


def word_code(word: bytes) -> int:
    """A negative number for a word; frequent words have numbers from 0 instead."""
    return -(xxhash.xxh64_intdigest(word) >> 1) - 1


END = word_code(b" ")  # no word holds a space


class Codes(dict):
    """Word -> number. A bounded memory: words beyond it are looked up again each time."""

    def __init__(self, hot: dict[int, int]):
        super().__init__()
        self.hot = hot

    def __missing__(self, word: bytes) -> int:
        code = word_code(word)
        code = self.hot.get(code, code)
        if len(self) < KNOWN_WORDS:
            self[word] = code
        return code

    def of(self, text: bytes) -> np.ndarray:
        """The numbers of a text's tokens, the end included."""
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pair_hash(pairs: np.ndarray) -> np.ndarray:
    """Hashes of n-grams or words that are given as numbers."""
    return mixed(pairs.astype(np.uint64) + _U(0x9E3779B97F4A7C15))


def quantum(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log(count)) to the base BASE."""
    return (1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-9)).astype(np.int64)


def count_of_quantum(q: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a quantum; 0 for 0."""
    low, high = np.ceil(BASE ** (q - 1.0) - 1e-6), np.maximum(np.ceil(BASE**q - 1e-6) - 1, 1)
    return np.where(q > 0, (low + np.maximum(low, high)) / 2, 0.0)


def bit_places(hashes: np.ndarray, level: int, probe: int, bits: int) -> np.ndarray:
    """Places in the filter; an n-gram's top bits choose its segment."""
    own = bits // SEGMENTS
    inside = mixed(hashes + _U((level * 8 + probe + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & _U(own - 1)
    return (hashes >> _U(58)) * _U(own) + inside


@dataclass
class Filter:
    """The log-frequency Bloom filter."""

    data: np.ndarray
    bits: int
    levels: int

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Approximate counts: probe one level after the other, each with all n-grams that passed the last."""
        q, left = np.zeros(len(hashes), dtype=np.int64), np.arange(len(hashes))
        for level in range(1, self.levels + 1):
            for probe in range(PROBES):
                place = bit_places(hashes[left], level, probe, self.bits)
                left = left[(self.data[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
            q[left] += 1
        return count_of_quantum(q)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(7, 2)).select(raw().alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """code, n of every token of the texts."""

    def run(batches):
        counts: dict[bytes, int] = {}
        ends = 0

        def emit():
            codes = [word_code(w) for w in counts]
            return pa.RecordBatch.from_arrays([pa.array([*codes, END], pa.int64()), pa.array([*counts.values(), ends], pa.int64())], names=["code", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for w in text.lower().split():
                    counts[w] = counts.get(w, 0) + 1
                ends += 1
                if len(counts) > 1_000_000:
                    yield emit()
                    counts, ends = {}, 0
        yield emit()

    return texts.mapInArrow(run, "code bigint, n bigint").where("n > 0").groupBy("code").agg(F.sum("n").alias("n"))


def pair_counts(texts: DataFrame, hot: dict[int, int]) -> DataFrame:
    """pair, n of every two neighbouring frequent tokens; the end stands before the first word, too."""

    def run(batches):
        codes, end = Codes(hot), hot.get(END, -1)
        parts, size = [], 0

        def emit():
            pairs, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                w = codes.of(text)
                u = np.concatenate(([end], w))
                w = np.concatenate((w, [end]))
                both = (u >= 0) & (w >= 0)
                parts.append((u[both] + 1) * HOT_WORDS + w[both])
                size += len(parts[-1])
                if size > 4_000_000:
                    yield emit()
                    parts, size = [], 0
        if parts:
            yield emit()

    return texts.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def filled(hashes: np.ndarray, counts: np.ndarray) -> Filter:
    """A filter of n-grams with their counts, of a size that they fill to BITS_PER_ENTRY or more."""
    q = quantum(counts)
    bits = max(1 << 16, 1 << math.ceil(math.log2(max(1, int(q.sum())) * BITS_PER_ENTRY)))
    flags, levels = np.zeros(bits, dtype=np.uint8), int(q.max(initial=1))
    for level in range(1, levels + 1):
        here = hashes[q >= level]
        for probe in range(PROBES):
            flags[bit_places(here, level, probe, bits).astype(np.int64)] = 1
    return Filter(np.packbits(flags, bitorder="little"), bits, levels)


@dataclass
class Model:
    """A fitted model: ``docs`` have the training texts, the rest is bounded."""

    docs: DataFrame
    tokens: int
    words: int
    hot: dict[int, int]  # code -> number
    hot_counts: np.ndarray
    hot_pairs: np.ndarray  # sorted
    hot_pair_counts: np.ndarray
    mass: float  # of the lower order in the smoothing


def fit_language_model(docs: DataFrame, masses: tuple[float, ...] = (30.0, 300.0, 3_000.0, 30_000.0)) -> Model:
    """Count all words of the training texts, and find the frequent ones and the frequent pairs.

    ``mass`` is the one of ``masses`` that makes the pairs of frequent words likeliest, each left out once.
    The counts of all other pairs are made where they are needed, see ``score_texts``.
    """
    texts = training_rows(docs)
    counts = landed(word_counts(texts), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, words = total["n"], total["v"]
    is_frequent = (F.col("n") * HOT_WORDS >= tokens) & (F.col("n") > 1)  # at most HOT_WORDS
    frequent = counts.where(is_frequent).orderBy("code").collect()
    hot = {r["code"]: i for i, r in enumerate(frequent)}
    hot_counts = np.array([r["n"] for r in frequent], dtype=np.int64)
    pairs = landed(pair_counts(texts, hot), "pair-counts")
    hot_pairs = np.array([(r["pair"], r["n"]) for r in pairs.where(is_frequent).orderBy("pair").collect()], dtype=np.int64).reshape(-1, 2)
    return Model(docs, tokens, words, hot, hot_counts, hot_pairs[:, 0].copy(), hot_pairs[:, 1].copy(), best_mass(pairs, hot_counts, tokens + words + 1, masses))


def best_mass(pairs: DataFrame, hot_counts: np.ndarray, norm: int, masses: tuple[float, ...]) -> float:
    """The smoothing mass under which all counted pairs, each left out once, are likeliest."""

    def gains(batches):
        for batch in batches:
            pair, n = batch["pair"].to_numpy(), batch["n"].to_numpy()
            u, w = pair // HOT_WORDS - 1, pair % HOT_WORDS
            low = (hot_counts[w] + 1) / norm
            yield batch.__class__({"i": range(len(masses)), "gain": [float((n * np.log((n - 1 + m * low) / (hot_counts[u] - 1 + m))).sum()) for m in masses]})

    found = pairs.mapInPandas(gains, "i int, gain double").groupBy("i").agg(F.sum("gain").alias("gain")).collect()
    return masses[max(found, key=lambda r: r["gain"])["i"]] if found else masses[0]


PART = pa.schema([
    ("bucket", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.float64()), ("score", pa.float64()), ("words", pa.binary()), ("runs", pa.binary()), ("others", pa.binary()), ("rows", pa.binary()), ("flags", pa.binary())])
ROW = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
ROW_NAMES = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
SUM = np.dtype([("row", "<i8"), ("known", "<i4"), ("base", "<f8"), ("score", "<f4")])  # what a segment adds to a row
OTHER_BYTES = 5  # of the hash of a pair's first word, which tells the pairs of one second word apart
TRAINS, SCORED = 1, 2


def pair_key(words: np.ndarray, others: np.ndarray) -> np.ndarray:
    return mixed(pair_hash(words) + others * _U(0x9E3779B97F4A7C15))


def packed(words: np.ndarray, others: np.ndarray, rows: np.ndarray, flags: np.ndarray, first_row: int, buckets: int) -> pa.RecordBatch:
    """Pairs, one entry for each occurrence, by the bucket that owns them.

    A word that is not frequent is owned, with all pairs that end on it, by one bucket; pairs that end on a frequent
    word are spread.
    """
    owner = np.where(words < 0, pair_hash(words), pair_key(words, others)) % _U(buckets)
    order = np.argsort(words)
    order = order[np.argsort(owner[order].astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")]
    owner, words, rows, flags = owner[order], words[order], rows[order].astype("<u2"), flags[order]
    others = others[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :OTHER_BYTES]
    new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, dtype=np.int64)
    columns: list[list] = [[] for _ in range(6)]
    for a, b in zip(new, np.append(new, len(owner))[1:], strict=True):
        own = words[a:b]
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        runs = np.diff(np.append(starts, b - a)).astype("<u4")
        for column, value in zip(columns, (int(owner[a]), own[starts].tobytes(), runs.tobytes(), others[a:b].tobytes(), rows[a:b].tobytes(), flags[a:b].tobytes()), strict=True):
            column.append(value)
    bucket, *data = columns
    n = len(bucket)
    own = {"bucket": bucket, "row": [first_row] * n, **dict(zip(("words", "runs", "others", "rows", "flags"), data, strict=True))}
    return pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(n, f.type) for f in PART], schema=PART)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; null texts are empty.

    A text's score is the sum over its words w after u of log10 low(w) - log10(n(u) + mass) + log10(mass + n(u, w) / low(w)).
    Frequent words and frequent pairs are scored where the text is read, all others by the bucket that owns them.
    A word stands as often before another as after one, so its owner settles both. Repeated rows are scored each on its own.
    """
    spark = docs.sparkSession
    order = np.argsort(model.hot_pairs)
    shared = spark.sparkContext.broadcast((model.hot, model.hot_counts, model.hot_pairs[order], model.hot_pair_counts[order]))
    norm, mass = model.tokens + model.words + 1, model.mass
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(7, 2).alias("held_out"), raw().alias("text"))
    if docs is model.docs:
        rows = rows.withColumn("flags", F.when(F.col("held_out"), SCORED).otherwise(SCORED + TRAINS))
    else:
        train = training_rows(model.docs).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(False).alias("held_out"), "text", F.lit(TRAINS).alias("flags"))
        rows = rows.withColumn("flags", F.lit(SCORED)).unionByName(train)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))  # of rows, for the sums
    buckets = max(groups, size // (6 * SEGMENT_TOKENS) + 1)

    def words_scored(n):
        """(low, the terms of the base score, those of the score that a word has by itself) for words with counts ``n``."""
        read = count_of_quantum(np.where(n > 0, quantum(n), 0))
        low = (read + 1) / norm
        return low, np.log10((n + 1) / norm), np.log10(low) - np.log10(read + mass)

    def run(batches):
        from pyspark import TaskContext

        hot, exact, pairs, pair_n = shared.value
        codes, end = Codes(hot), hot.get(END, END)
        low, base, alone = words_scored(exact)
        read = count_of_quantum(quantum(pair_n))
        following, first = TaskContext.get().partitionId() << 33, TaskContext.get().partitionId() << 33
        held, n_held = [], 0

        def emit():
            return packed(*(np.concatenate(c) for c in zip(*held, strict=True)), first, buckets)

        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                tokens = [codes.of(t) for t in batch.column(2).to_pylist()]
                w = np.concatenate([x for t in tokens for x in (t, [end])]).astype(np.int64)
                u = np.concatenate([x for t in tokens for x in ([end], t)]).astype(np.int64)
                flags = batch.column(3).to_numpy(zero_copy_only=False).astype(np.uint8)
                sizes = np.array([len(t) + 1 for t in tokens])
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                known = w >= 0
                plain, score = np.zeros(len(w)), np.zeros(len(w))
                plain[known], score[known] = base[w[known]], alone[w[known]]
                here = np.flatnonzero(known & (u >= 0))
                ids = (u[here] + 1) * HOT_WORDS + w[here]
                at = np.searchsorted(pairs, ids)
                found = at < len(pairs)
                found[found] = pairs[at[found]] == ids[found]
                here, at = here[found], at[found]
                score[here] += np.log10(mass + read[at] / low[w[here]])
                left = np.ones(len(w), dtype=bool)
                left[here] = False
                number = np.repeat(np.arange(len(tokens)), sizes)[left]
                held.append((w[left], pair_hash(u[left]) >> _U(64 - 8 * OTHER_BYTES), number + (following - first), flags[number]))
                n_held += int(left.sum())
                scored = flags & SCORED > 0
                n = int(scored.sum())
                sums = (sizes, np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(plain, starts), np.add.reduceat(score, starts))
                own = {"bucket": (np.flatnonzero(scored) + following) % buckets, "row": np.flatnonzero(scored) + following, **dict(zip(("n_tokens", "n_known", "base", "score"), (x[scored] for x in sums), strict=True))}
                keep = pa.array(scored)
                own |= {"doc_id": batch.column(0).filter(keep), "held_out": batch.column(1).filter(keep)}
                yield pa.RecordBatch.from_arrays([(own[f.name] if isinstance(own[f.name], pa.Array) else pa.array(own[f.name], f.type)) if f.name in own else pa.nulls(n, f.type) for f in PART], schema=PART)
                following += batch.num_rows
                if n_held > FLUSH_PAIRS or following - first > FLUSH_ROWS:
                    yield emit()
                    held, n_held, first = [], 0, following
        if held:
            yield emit()

    def owned(part: pa.Table) -> pa.Table:
        settled = part.filter(part["words"].is_null())
        groups_of = (pair_hash(settled["row"].to_numpy()) % _U(groups)).astype(np.int32)
        settled = settled.select(ROW_NAMES).add_column(0, "group", pa.array(groups_of, pa.int32())).append_column("sums", pa.nulls(len(settled), pa.binary()))
        part = part.filter(part["words"].is_valid())
        if not part.num_rows:
            return settled
        exact = shared.value[1]
        words, runs, others, rows, flags = (np.frombuffer(b"".join(part[c].to_pylist()), dtype=t) for c, t in (("words", "<i8"), ("runs", "<u4"), ("others", "u1"), ("rows", "<u2"), ("flags", "u1")))
        words = np.repeat(words, runs)
        wide = np.zeros((len(words), 8), dtype=np.uint8)
        wide[:, :OTHER_BYTES] = others.reshape(-1, OTHER_BYTES)
        trains, scored = flags & TRAINS > 0, flags & SCORED > 0

        grams, gram = np.unique(pair_key(words, wide.view("<u8").ravel()), return_inverse=True)
        del wide, others
        n = np.bincount(gram[trains], minlength=len(grams))
        together = filled(grams[n > 0], n[n > 0]).counts(grams)[gram]
        del grams, gram
        kinds, kind = np.unique(words, return_inverse=True)
        rare = kinds < 0
        n = np.bincount(kind[trains], minlength=len(kinds))  # all places of a rare word are here
        n[~rare] = exact[kinds[~rare]]
        low, base, alone = words_scored(n)
        met = (rare & (n > 0)).astype(float)
        base, alone, most = np.where(rare, base, 0.0), np.where(rare, alone, 0.0), count_of_quantum(np.where(n > 0, quantum(n), 0))
        score = alone[kind] + np.log10(mass + np.minimum(together, most[kind]) / low[kind])
        del together

        rows = np.repeat(part["row"].to_numpy(), [len(f) for f in part["flags"].to_pylist()]) + rows
        texts, text = np.unique(rows[scored], return_inverse=True)
        sums = np.zeros(len(texts), dtype=SUM)
        sums["row"] = texts
        for name, value in (("known", met[kind]), ("base", base[kind]), ("score", score)):
            sums[name] = np.bincount(text, value[scored], len(texts))
        group = (pair_hash(sums["row"]) % _U(groups)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        group, sums = group[order], sums[order]
        new = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, dtype=np.int64)
        # field by field, which compresses better
        data = [b"".join(np.ascontiguousarray(sums[f][a:b]).tobytes() for f in SUM.names) for a, b in zip(new, np.append(new, len(group))[1:], strict=True)]
        back = {"group": pa.array(group[new], pa.int32()), "sums": pa.array(data, pa.binary())}
        return pa.concat_tables([settled, pa.table([back.get(f.name, pa.nulls(len(new), f.type)) for f in settled.schema], schema=settled.schema)])

    def summed(part: pa.Table) -> pa.Table:
        settled = part.filter(part["sums"].is_null()).select(ROW_NAMES).sort_by("row")
        rows = settled["row"].to_numpy()
        totals = [settled[c].to_numpy().copy() for c in ROW_NAMES[-3:]]
        for data in part["sums"].drop_null().to_pylist():
            at, n = 0, len(data) // SUM.itemsize
            fields = []
            for f in SUM.names:
                fields.append(np.frombuffer(data, dtype=SUM[f], count=n, offset=at))
                at += n * SUM[f].itemsize
            place = np.searchsorted(rows, fields[0])  # a row is once in each of them
            for total, more in zip(totals, fields[1:], strict=True):
                total[place] += more
        return pa.table([*(settled[c] for c in ROW_NAMES[:-3]), *map(pa.array, totals)], names=ROW_NAMES)

    ddl = "bucket int, " + ROW + ", words binary, runs binary, others binary, rows binary, flags binary"
    back = rows.mapInArrow(run, ddl).groupBy("bucket").applyInArrow(owned, f"group int, {ROW}, sums binary")
    return back.groupBy("group").applyInArrow(summed, ROW).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")
