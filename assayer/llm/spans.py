"""Substring deduplication by sliding sentence spans.

A sentence ends after its mark or line; one of LONG words or more is cut further, at words that its own content
chooses (the least hash of every LONG words running), so that a passage is cut alike wherever it stands. A span is
a run of consecutive sentences: from every sentence on the shortest run that holds LEAST_WORDS words, and up to
every sentence the shortest such run; usually two to four sentences. All spans are hashed (128 bits) and joined
over the corpus. The first of equal spans is that with the smallest (doc_id, sentence); sentences that any other
one covers are removed. Of a passage that repeats from within a long sentence, fewer than LONG words at either end
can stay. In scripts without spaces each character counts as a word.
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import landed

LEAST_WORDS = 20
LONG = 16
_CUT = re.compile(r"(?<=[.!?])[^\S\n]+|\s*\n\s*")
# Thai to Lao, Burmese, Khmer, kana and CJK with their marks, full-width forms
_NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3001-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_NO_SPACES}]")
_CUT_UNSPACED = re.compile(r"\s*\n\s*|(?<=[.!?])[^\S\n]+|(?<=[\u3002\uff01\uff1f\uff61])[^\S\n]*")
_WORD_UNSPACED = re.compile(f"[{_NO_SPACES}]|[^\\s{_NO_SPACES}]+")
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NO_ID = -(1 << 63)  # stands for a null id
SPAN = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("mark", "<i8"), ("first", "<i4"), ("count", "<i4")])


def sentences(text: str) -> list[str]:
    """A text in pieces that end after a sentence's mark and white space, after line ends, or within long sentences
    at words that these choose; joined they are the text."""
    unspaced = not text.isascii() and _UNSPACED.search(text) is not None
    edges = [0, *(m.end() for m in (_CUT_UNSPACED if unspaced else _CUT).finditer(text)), len(text)]
    more = chosen_cuts(text, edges, unspaced)
    if more:
        edges = sorted(edges + more)
    return [text[a:b] for a, b in pairwise(edges) if b > a]


def chosen_cuts(text: str, edges: list[int], unspaced: bool) -> list[int]:
    """Places of words before which sentences of LONG words and more are cut.

    Of every LONG - 1 consecutive pairs of words in such a sentence the first with the least hash is chosen, so that
    what stands LONG words away has no influence. Words that repeat at once are not chosen again for LONG - 1 words.
    """
    if max(b - a for a, b in pairwise(edges)) < (LONG if unspaced else 2 * LONG - 1):
        return []
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = code > 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if unspaced:
        alone = np.zeros(len(code), dtype=bool)
        alone[[m.start() for m in _UNSPACED.finditer(text)]] = True
        begins |= alone
        begins[1:] |= inside[1:] & alone[:-1]
    starts = np.flatnonzero(begins)
    if len(starts) < LONG:
        return []
    last = inside
    last[:-1] &= begins[1:] | ~inside[1:]
    ends = np.flatnonzero(last)
    # a word's hash is of its first two and its last character and its length; case does not matter
    word = (code[starts] | 32) * _B1 + (code[np.minimum(starts + 1, ends)] | 32) * _B2
    word += ((code[ends] | 32) + ((ends - starts) << 21).astype(np.uint64)) * (_B1 ^ _B2)
    pairs = ((word[:-1] ^ (word[:-1] >> np.uint64(31))) * _B2 + (word[1:] ^ (word[1:] >> np.uint64(29)))) * _B1 >> np.uint64(32)
    # the least of LONG - 1 = 8 + 7 pairs, the first among equal ones
    key = pairs << np.uint64(32) | np.arange(len(pairs), dtype=np.uint64)
    for step in (1, 2, 4, LONG - 9):
        key = np.minimum(key[:-step], key[step:])
    sentence = np.searchsorted(edges, starts, side="right")
    whole = sentence[: len(key)] == sentence[LONG - 1 :]
    chosen = np.unique(key[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if (pairs[chosen[1:]] == pairs[chosen[:-1]]).any():
        kept: list[int] = []
        for c in chosen.tolist():
            if not kept or pairs[c] != pairs[kept[-1]] or c - kept[-1] >= LONG - 1:
                kept.append(c)
        chosen = np.array(kept)
    return starts[chosen].tolist()


def words_of(piece: str) -> list[str]:
    """Lower-cased words; in scripts without spaces, characters."""
    if not piece.isascii() and _UNSPACED.search(piece):
        return _WORD_UNSPACED.findall(piece.lower())
    return piece.lower().split()


def spans_of(text: str, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, number of sentences, two hashes) of the spans of a text, each span once.

    Sentences without a word belong to no span but may lie inside one.
    """
    digests, counts, places = [], [], []
    for place, piece in enumerate(sentences(text)):
        words = words_of(piece)
        if words:
            digests.append(xxhash.xxh3_128_digest(" ".join(words)))
            counts.append(len(words))
            places.append(place)
    nothing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    total = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    if total[-1] < least_words:
        return nothing
    at, n = np.array(places, dtype=np.int64), len(places)
    ends = np.searchsorted(total, total[:-1] + least_words)  # after the last sentence of the run from each one
    starts = np.searchsorted(total, total[1:] - least_words, side="right") - 1  # the first one of the run up to each
    ahead, back = ends <= n, total[1:] >= least_words
    runs = np.unique(np.concatenate((
        np.stack((np.arange(n)[ahead], ends[ahead]), 1), np.stack((starts[back], np.arange(1, n + 1)[back]), 1))), axis=0)
    a, b = runs[:, 0], runs[:, 1]
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    out = []
    for k, base in ((0, _B1), (1, _B2)):
        # polynomials over the sentences' hashes, by sums over all sentences so far
        longest = int((b - a).max())
        powers = np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(longest, base))))
        value = np.zeros(len(a), dtype=np.uint64)
        for step in range(longest):
            more = a + step < b
            value[more] = value[more] * base + both[a[more] + step, k]
        out.append(value ^ powers[b - a])
    return at[a], at[b - 1] - at[a] + 1, out[0], out[1]


def not_first(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of each group of equal spans, all others)"""
    order = np.lexsort((spans["first"], spans["mark"], spans["doc"], spans["h2"], spans["h1"]))
    spans = spans[order]
    if not len(spans):
        return spans, spans
    first = np.concatenate(([True], (spans["h1"][1:] != spans["h1"][:-1]) | (spans["h2"][1:] != spans["h2"][:-1])))
    group = np.cumsum(first) - 1
    leader = spans[first][group]
    # rows that are equal altogether stand at one place, so they share their spans
    same = (spans["doc"] == leader["doc"]) & (spans["mark"] == leader["mark"]) & (spans["first"] == leader["first"])
    return spans[first], spans[~same]


PART = pa.schema([("bucket", pa.int32()), ("doc", pa.int64()), ("mark", pa.int64()), ("data", pa.binary())])


def repeated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc, mark, data: sentences of a document that other than first spans cover, as pairs of (first, count).

    A task settles the spans that repeat among its own rows and sends only the first of each on, so a passage
    of very many documents is sent once by each task.
    """
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_document(spans: np.ndarray) -> pa.Table:
        order = np.lexsort((spans["first"], spans["mark"], spans["doc"]))
        spans = spans[order]
        new = np.concatenate(([True], (spans["doc"][1:] != spans["doc"][:-1]) | (spans["mark"][1:] != spans["mark"][:-1]))) if len(spans) else np.zeros(0, dtype=bool)
        starts = np.flatnonzero(new)
        pairs = np.stack((spans["first"], spans["count"]), 1).astype("<i4")
        data = [pairs[s:e].tobytes() for s, e in zip(starts, np.append(starts, len(spans))[1:], strict=True)]
        bucket = np.arange(len(starts), dtype=np.int32) % buckets  # anywhere: equal texts need not meet here
        return pa.table([pa.array(bucket, pa.int32()), pa.array(spans["doc"][starts], pa.int64()), pa.array(spans["mark"][starts], pa.int64()), pa.array(data, pa.binary())], schema=PART)

    def prepare(batches):
        held, size = [], 0

        def emit():
            first, others = not_first(np.concatenate([*held, np.zeros(0, dtype=SPAN)]))
            yield from by_document(others).to_batches()
            bucket = (first["h1"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, first = bucket[order], first[order]
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, dtype=int)
            packed = [first[s:e].tobytes() for s, e in zip(starts, np.append(starts, len(first))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int32()), pa.nulls(len(packed), pa.int64()), pa.nulls(len(packed), pa.int64()), pa.array(packed, pa.binary())], schema=PART)

        for batch in batches:
            for doc, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, count, h1, h2 = spans_of(text, least_words)
                if len(first):
                    own = np.zeros(len(first), dtype=SPAN)
                    own["h1"], own["h2"], own["doc"], own["mark"], own["first"], own["count"] = h1, h2, doc, mark, first, count
                    held.append(own)
                    size += len(own)
            if size > 1_000_000:
                yield from emit()
                held, size = [], 0
        yield from emit()

    def join(rows: pa.Table) -> pa.Table:
        settled = rows["doc"].is_valid()
        packed = [np.frombuffer(d, dtype=SPAN) for d in rows["data"].filter(rows["doc"].is_null()).to_pylist()]
        others = not_first(np.concatenate([*packed, np.zeros(0, dtype=SPAN)]))[1]
        return pa.concat_tables([rows.filter(settled), by_document(others)]).select(["doc", "mark", "data"])

    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("mark"), "text")
    return landed(texts.mapInArrow(prepare, "bucket int, doc bigint, mark bigint, data binary").groupBy("bucket").applyInArrow(join, "doc bigint, mark bigint, data binary"), "repeated-spans")


def remove_repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS, count_as: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the columns it has and ``text`` without removed sentences.

    ``count_as`` names columns for the numbers of all and of removed sentences; columns of these names are replaced.
    No document goes: one whose
    sentences all go keeps an empty text, null stays null. Equal rows keep the same; rows without an id come
    before all others.
    """
    gone = repeated(docs, least_words).groupBy("doc", "mark").agg(F.collect_list("data").alias("pairs")).hint("shuffle_hash")
    joined = docs.join(gone, (F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)) == gone["doc"]) & (F.xxhash64(docs["text"]) == gone["mark"]), "left")

    @F.pandas_udf("text string, sentences int, removed int")
    def cleaned(texts, lists):
        import pandas as pd

        rows = []
        for text, data in zip(texts, lists, strict=True):
            if text is None:
                rows.append((None, 0, 0))
                continue
            pieces = sentences(text)
            covered = np.zeros(len(pieces) + 1, dtype=np.int64)
            for pairs in data if data is not None else ():
                pairs = np.frombuffer(pairs, dtype="<i4").reshape(-1, 2)
                np.add.at(covered, pairs[:, 0], 1)
                np.add.at(covered, pairs[:, 0] + pairs[:, 1], -1)
            stays = np.cumsum(covered)[:-1] == 0
            rows.append((text if stays.all() else "".join(p for p, s in zip(pieces, stays, strict=True) if s), len(pieces), int((~stays).sum())))
        return pd.DataFrame(rows, columns=["text", "sentences", "removed"])

    found = joined.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), cleaned(docs["text"], gone["pairs"]).alias("clean"))
    counts = [F.col(f"clean.{c}").alias(name) for c, name in zip(("sentences", "removed"), count_as or (), strict=False)]
    others = [c for c in docs.columns if c not in (count_as or ())]
    return found.select(*(F.col("clean.text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in others), *counts)
