"""Best-fit packing of documents into sequences, after Martello and Toth's reduction.

Only the histogram of piece lengths (at most ``capacity`` numbers) decides the packing, so it is computed on
the driver whatever the number of documents: sets of pieces that provably dominate all others with the same
longest piece are fixed for good, the rest is packed best-fit. The plan says how many sequences of each
pattern there are; pieces of a length are numbered in parallel and look up their places.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import kept, landed, raw

CAPACITY = 2048
# Letters and signs for which the plain pattern below cuts as the tokeniser's own does.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
KNOWN_PIECES = 800_000


class Tokens:
    """Ids of a text as little-endian 32-bit numbers. Each different word is encoded once and kept.

    The tokeniser's added tokens part a text before its words are cut.
    """

    def __init__(self, ranks_file: str | None = None):
        import base64
        import json
        import re

        import public_tokenizers
        import regex
        import tiktoken

        with open(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.common, self.plain = re.compile(rf"[\t\n -~{_LETTERS}]*").fullmatch, re.compile(_SPLIT).findall
        self.full = regex.compile(public_tokenizers.PATTERN).findall
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.added = {content: np.array([number], dtype="<u4").tobytes() for content, number in added.items()}
        self.parted = re.compile("(" + ("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or "(?!)") + ")").split
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        known, out = self.known, []
        for k, part in enumerate(self.parted(text)):
            if k % 2:
                out.append(self.added[part])
                continue
            for piece in self.plain(part) if self.common(part) else self.full(part):
                found = known.get(piece)
                if found is None:
                    found = np.array(self.encoding._encode_single_piece(piece), dtype="<u4").tobytes()
                    if len(known) < KNOWN_PIECES:
                        known[piece] = found
                out.append(found)
        out.append(b"\0\0\0\0")
        return b"".join(out)


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a shorter first one."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


@dataclass
class Plan:
    """Patterns (lengths, longest first) with the number of sequences of each; ``reduced`` counts fixed ones."""

    patterns: list[tuple[tuple[int, ...], int]]
    reduced: int

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.patterns)

    def places(self) -> dict[str, np.ndarray]:
        """For each length and slot of a pattern the run of its pieces: length, from, sequence, offset; sorted."""
        rows, taken, base = [], Counter(), 0
        for lengths, n in self.patterns:
            offset = 0
            for length in lengths:
                rows.append((length, taken[length], base, offset))
                taken[length] += n
                offset += length
            base += n
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        return dict(zip(("length", "first", "sequence", "offset"), table.T, strict=True))


def longest_pair(fits: list[int], counts: Counter, room: int) -> int:
    """The greatest total of two pieces that is at most ``room``; 0 if no two fit."""
    low, high, pair = 0, len(fits) - 1, 0
    while low <= high:
        total = fits[low] + fits[high]
        if total > room:
            high -= 1
            continue
        if low < high or counts[fits[low]] > 1:
            pair = max(pair, total)
        low += 1
    return pair


def reduce_and_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``histogram[length]`` pieces of each length.

    Reduction: with the longest piece left as j, room r = capacity - j. No other fits: {j} is fixed. A piece
    of exactly r fits: {j, r}. Not even the two shortest others fit together: {j, longest that fits}. No three
    fit, and no two are together longer than the longest that fits: {j, that one}. Each such set
    dominates every other set that holds j, so that some best packing has it. As many equal sets are fixed
    at once as there are. If none applies j is set aside, and the next longest is looked at.
    """
    left = {k: n for k, n in sorted(histogram.items(), reverse=True) if n > 0}
    plan: list[tuple[tuple[int, ...], int]] = []
    aside: dict[int, int] = {}

    def take(*lengths: int) -> None:
        need = Counter(lengths)
        n = min(left[k] // c for k, c in need.items())
        plan.append((lengths, n))
        for k, c in need.items():
            left[k] -= n * c
            if not left[k]:
                del left[k]

    while left:
        j = max(left)
        room = capacity - j
        # the pieces set aside may still go with j, so they count among the others
        others = Counter(left) + Counter(aside)
        others[j] -= 1
        fits = sorted(k for k, n in others.items() if n > 0 and k <= room)
        if not fits:
            take(j)
            continue
        best = fits[-1]
        short = [k for k in fits[:3] for _ in range(min(others[k], 3))][:3]
        alone = len(short) < 2 or sum(short[:2]) > room
        at_most_two = len(short) < 3 or sum(short) > room
        if best == room or alone or at_most_two and longest_pair(fits, others, room) <= best:
            if best in aside:
                n = min(left[j], aside[best])
                plan.append(((j, best), n))
                left[j] -= n
                aside[best] -= n
                left, aside = {k: v for k, v in left.items() if v}, {k: v for k, v in aside.items() if v}
            elif best == j:
                if left[j] < 2:
                    aside[j] = aside.get(j, 0) + left.pop(j)
                else:
                    take(j, j)
            else:
                take(j, best)
        else:
            aside[j] = aside.get(j, 0) + left.pop(j)
    reduced = sum(n for _, n in plan)

    open_by_room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(aside, reverse=True):
        n = aside[length]
        while n:
            room = min((r for r in open_by_room if r >= length), default=None)
            if room is None:
                per = capacity // length
                full, rest = divmod(n, per)
                for count, lengths in ((full, (length,) * per), (1 if rest else 0, (length,) * rest)):
                    if count:
                        bins = open_by_room.setdefault(capacity - sum(lengths), {})
                        bins[lengths] = bins.get(lengths, 0) + count
                break
            lengths = next(iter(open_by_room[room]))
            have = open_by_room[room].pop(lengths)
            if not open_by_room[room]:
                del open_by_room[room]
            per = min(room // length, n)
            used = min(have, n // per)
            bins = open_by_room.setdefault(room - per * length, {})
            bins[lengths + (length,) * per] = bins.get(lengths + (length,) * per, 0) + used
            if have > used:
                back = open_by_room.setdefault(room, {})
                back[lengths] = back.get(lengths, 0) + have - used
            n -= used * per
    plan += [(lengths, n) for bins in open_by_room.values() for lengths, n in bins.items()]
    return Plan(plan, reduced)


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = True, ranks_file: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit) of every piece.

    A null text is empty. Every document ends with id 0, so an empty one is one piece of one id.
    """
    schema = PIECE if with_ids else pa.schema(list(PIECE)[:-1])

    def run(batches):
        tokens = kept(f"tokens {ranks_file}", lambda: Tokens(ranks_file))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = tokens.ids(text.decode())
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, number, start, length, zlib.crc32(own), own))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema=schema)

    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).mapInArrow(run, ddl)


def numbered(pieces: DataFrame, per_group: int = 20_000) -> DataFrame:
    """``pieces`` with ``_rank``: numbers from 0 within each length.

    Pieces of a length are dealt into as many groups as it takes for some ``per_group`` rows each, and
    numbered within; groups follow each other by their counted sizes. No length has to fit one task.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    groups = max(1, max(counts.values(), default=0) // per_group)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))
    sizes = dealt.groupBy("length", "_group").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "_group", F.coalesce(before, F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    own = dealt.withColumn("_row", F.row_number().over(order) - 1)
    return own.join(sizes, ["length", "_group"]).withColumn("_rank", F.col("_row") + F.col("_before")).drop("_group", "_row", "_before")


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, ranks_file: str | None = None) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``.

    Rows with the same doc_id, and rows without one, are packed each on its own; an empty table gives none.
    """
    pieces = landed(pieces_of(docs, capacity, with_ids, ranks_file), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = reduce_and_fit(histogram, capacity)
    places = plan.places()  # some numbers for each length and pattern: bounded by the capacity, not by the documents
    starts = {int(k): np.searchsorted(places["length"], k) for k in np.unique(places["length"])}
    ends = {k: int(np.searchsorted(places["length"], k, side="right")) for k in starts}
    first, sequence, offset = places["first"], places["sequence"], places["offset"]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(lengths, ranks):
        import pandas as pd

        seq, off = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        values, rank = lengths.to_numpy(), ranks.to_numpy()
        for k in np.unique(values):
            rows = np.flatnonzero(values == k)
            a, b = starts[int(k)], ends[int(k)]
            at = a + np.searchsorted(first[a:b], rank[rows], side="right") - 1
            seq[rows], off[rows] = sequence[at] + rank[rows] - first[at], offset[at]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    placed = numbered(pieces).withColumn("_place", place("length", "_rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "_place.*")
