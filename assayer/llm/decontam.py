"""Benchmark decontamination: one Aho-Corasick automaton over all windows of the benchmark's words.

Texts are normalised (A-Z lower-cased, words of letters, digits and non-ASCII characters, one space between
two) and scanned once; the places of the matches lead back to the words and characters of the original.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import LOWER, UPPER, raw

WINDOW = 10
# The most bytes of normalised benchmark text that go into one automaton, and so to every executor.
BLOCK_BYTES = 4_000_000
_DROP = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_TO = bytes.maketrans(UPPER.encode() + _DROP, LOWER.encode() + b" " * len(_DROP))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO).split()


def windows(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words; all words as one if there are fewer, none if there are none."""
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Scanner:
    """Finds the windows of benchmark items in texts. Built where it is used, from (item, normalised words)."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows(text.split(b" ") if text else [], size):
                owners.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton() if owners else None
        for window, found in owners.items():
            # bytes as characters: one character a byte, so that places are byte places
            self.automaton.add_word(f" {window.decode('latin-1')} ", (len(window), window.count(b" ") + 1, tuple(sorted(found))))
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str], list[tuple[int, int]]]:
        """(which words are hit, items found, runs of hit words as (first, after last))"""
        hit, items, runs = np.zeros(len(words), dtype=bool), set(), []
        if self.automaton is None or not words:
            return hit, items, runs
        starts = None
        for end, (length, count, found) in self.automaton.iter(f" {b' '.join(words).decode('latin-1')} "):
            if starts is None:
                starts = np.cumsum([1] + [len(w) + 1 for w in words[:-1]]).tolist()
            first = bisect_left(starts, end - length)
            hit[first : first + count] = True
            items.update(found)
        if items:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
            runs = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        return hit, items, runs


def character_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as (first character, after last character) of the original text."""
    if not runs:
        return []
    kept = np.frombuffer(text.translate(_TO), dtype=np.uint8) != 32
    # only ASCII white space and signs part words, and 9 to 13 became spaces too
    edges = np.flatnonzero(np.diff(np.concatenate(([0], kept.astype(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    at = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return [(int(at[starts[a]]), int(at[ends[b - 1]])) for a, b in runs]


RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def blocks_of(benchmark: DataFrame, size: int = WINDOW) -> list[list[tuple[str, bytes]]]:
    """The benchmark in blocks of at most BLOCK_BYTES: a stated query set, read block by block. Rows without an id are one item, named by the empty text."""
    blocks, filled = [[]], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), raw().alias("text")).toLocalIterator():
        text = b" ".join(words_of(bytes(row["text"])))
        if filled and filled + len(text) > BLOCK_BYTES:
            blocks.append([])
            filled = 0
        blocks[-1].append((row["item"], text))
        filled += len(text)
    return blocks


def matches(block: list[tuple[str, bytes]], text: Column, size: int = WINDOW) -> Column:
    """What a block of the benchmark finds in a column of UTF-8 bytes, as a struct of RESULT."""
    state: dict = {}

    @F.pandas_udf(RESULT)
    def found(texts):
        import pandas as pd

        scanner = state.get("scanner") or state.setdefault("scanner", Scanner(block, size))
        rows = []
        for t in texts:
            words = words_of(t)
            hit, items, runs = scanner.scan(words)
            rows.append((len(words), int(hit.sum()), sorted(items), [{"start": a, "end": b} for a, b in character_spans(t, runs)]))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return found(text)


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans for every row of ``docs``.

    ``items`` are the sorted items of which a window occurs, ``spans`` the hit places in characters of the
    original text. Null and empty texts have no words. With a benchmark of several blocks the text is scanned
    once for each, and the places of all blocks are united.
    """
    blocks = blocks_of(benchmark, size)
    parts = [matches(block, raw(), size) for block in blocks]
    if len(parts) == 1:
        return docs.select("doc_id", parts[0].alias("m")).select("doc_id", "m.*")
    several = docs.select("doc_id", raw().alias("text"), F.array(*parts).alias("m"))
    spans = F.array_sort(F.flatten(F.col("m.spans")))

    @F.pandas_udf("n_hit bigint, spans array<struct<start:bigint,end:bigint>>")
    def united(texts, lists):
        import pandas as pd

        rows = []
        for t, found in zip(texts, lists, strict=True):
            whole: list[list[int]] = []
            for s in found:
                if whole and s["start"] <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], s["end"])
                else:
                    whole.append([s["start"], s["end"]])
            text = t.decode()
            rows.append((sum(len(words_of(text[a:b].encode())) for a, b in whole), [{"start": a, "end": b} for a, b in whole]))
        return pd.DataFrame(rows, columns=["n_hit", "spans"])

    every = several.select("doc_id", F.col("m")[0]["n_words"].alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.col("m.items")))).alias("items"), united("text", spans).alias("u"))
    return every.select("doc_id", "n_words", "u.n_hit", "items", "u.spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs; all columns stay as they are."""
    clean = F.lit(True)
    for block in blocks_of(benchmark, size):
        clean = clean & (matches(block, raw(), size)["n_hit"] == 0)
    return docs.where(clean)


def digest_items(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


SQL = r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS v
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS v
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), found AS (
  SELECT p.doc_id, p.i, p.n, m.item FROM places p JOIN item_windows m ON p.v = m.v AND p.n = m.n
), hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
