"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose feature lies beyond a cutoff. For every stratum (script and length of the
text) one half of the labelled documents proposes a path: candidate cutoffs of all rules, ordered by how many
good documents they cost for the bad ones they catch, so that each step rejects all that the step before did
and more. The other half, held out, certifies the path step by step: the strictest step is taken up to which
the exact upper binomial bound of the share of good documents rejected stays within the allowed risk. Testing
nested steps in an order fixed beforehand, and stopping at the first failure, keeps the error of a stratum;
the error is divided over the strata by Bonferroni.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import landed, raw

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS, REPEAT_SHARE, RUN = 20, 30, 8
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_NOT_MARK = bytes(c for c in range(256) if c not in b"!?")
_BLANK_OR_TAIL = bytes([32, *range(9, 14), *range(128, 192)])
_LEAD = bytes(range(0xC2, 0xF5))
_URL = re.compile(rb"https?://|www\.|@[a-z0-9-]+\.", re.I)

# feature -> +1 if high values are bad, -1 if low ones are
RULES = {
    "symbol_share": 1, "upper_share": 1, "digit_share": 1, "mark_share": 1, "dup_line_share": 1, "repeat_share": 1,
    "top_word_share": 1, "mean_word": 1, "short_word": -1, "variety": -1, "link_share": 1, "line_words": -1,
}


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words that lie in a run of ``run`` words found twice or more in the text, the first place included."""
    n = len(words) - run + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.uint64, count=len(words))
    # runs are told apart exactly: pairs of numbers are numbered anew, then pairs of pairs
    width, same = 1, ids
    while width < run:
        step = min(width, run - width)
        pairs = same[: len(same) - step] * np.uint64(len(words) + 1) + same[step:]
        same = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        width += step
    counts = np.bincount(same.astype(np.int64))
    starts = np.flatnonzero(counts[same.astype(np.int64)] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + run, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: bytes) -> tuple:
    """The base numbers, the stratum and the features of a text."""
    words = text.split()
    n = len(words)
    seen, dup_lines, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    chars = len(text.translate(None, _BLANK_OR_TAIL))
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    repeats = repeated_words(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    wide = len(text) - len(text.translate(None, _LEAD))
    share = 1 / max(n, 1)
    features = (
        symbols / max(chars, 1), len(text.translate(None, _NOT_UPPER)) / max(chars, 1), len(text.translate(None, _NOT_DIGIT)) / max(chars, 1),
        len(text.translate(None, _NOT_MARK)) * share, dup_lines / max(lines, 1), repeats * share, max(counts.values(), default=0) * share,
        chars * share, chars * share, len(counts) * share ** 0.5 if n else 0.0, len(_URL.findall(text)) * share, n / max(lines, 1),
    )
    stratum = f"{'wide' if wide > 0.03 * max(chars, 1) else 'plain'}-{'short' if n < 150 else 'middle' if n < 600 else 'long'}"
    return n, chars, symbols, dup_lines, repeats, stratum, *features


SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in BASE), ("stratum", pa.string()), *((c, pa.float64()) for c in RULES)])
DDL = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", stratum string, " + ", ".join(f"{c} double" for c in RULES)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, base numbers, stratum and features for every row; null texts are empty."""

    def run(batches):
        for batch in batches:
            rows = [(i, *measures(t)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("bigint"), raw().alias("text")).mapInArrow(run, DDL)


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact (Clopper-Pearson) upper bound of a share of which ``k`` of ``n`` were seen."""
    if n == 0 or k >= n:
        return 1.0
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most_k(p: float) -> float:
        return sum(math.exp(t + i * math.log(p) + (n - i) * math.log1p(-p)) for i, t in enumerate(terms))

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if mid <= 0 or mid >= 1:
            break
        low, high = (mid, high) if at_most_k(mid) > error else (low, mid)
    return high


@dataclass(frozen=True)
class Risk:
    """At most ``false_rejection`` of any stratum's good documents are rejected, with probability 1 - ``error``.

    A candidate is proposed only if it catches ``lift`` times as large a share of the bad as of the good, by
    itself and in what it adds to the candidates before it.
    """

    false_rejection: float = 0.05
    error: float = 0.05
    candidates: int = 40
    lift: float = 3.0


@dataclass
class Rules:
    """For each stratum and rule the cutoffs from mild to strict with their steps; the last certified step."""

    cuts: dict[tuple[str, str], np.ndarray]
    steps: dict[tuple[str, str], np.ndarray]
    certified: dict[str, int]

    def first_step(self, strata: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The first step that rejects each document and the number of its rule; -1 for never."""
        never = np.iinfo(np.int64).max
        step, rule = np.full(len(strata), never), np.full(len(strata), -1)
        for stratum in set(strata):
            rows = np.flatnonzero(strata == stratum)
            for r, (c, sign) in enumerate(RULES.items()):
                cuts = self.cuts.get((stratum, c))
                if cuts is None or not len(cuts):
                    continue
                # cutoffs fall for high values and rise for low ones: the first that a value lies beyond
                at = np.searchsorted(-sign * cuts, -sign * values[c][rows], side="right")
                own = np.append(self.steps[stratum, c], never)[at]
                better = own < step[rows]
                step[rows[better]], rule[rows[better]] = own[better], r
        return np.where(step == never, -1, step), rule


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


def first_step(rules: Rules) -> Column:
    """struct<step, rule> of each document under the rules; -1 for never."""

    @F.pandas_udf("step bigint, rule int")
    def found(strata, *columns):
        import pandas as pd

        step, rule = rules.first_step(strata.to_numpy(), {c: v.to_numpy() for c, v in zip(RULES, columns, strict=True)})
        return pd.DataFrame({"step": step, "rule": rule.astype("int32")})

    return found("stratum", *RULES)


def learn_rules(features: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> Rules:
    """Propose on one half of the labelled documents (by a hash of the id), certify on the other.

    Only quantiles and counts reach the driver: strata x rules x candidates, however many documents there are.
    """
    judged = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    known = features.where(~base_failed()).join(judged, F.col("doc_id") == F.col("_id")).withColumn("held", F.pmod(F.xxhash64("_id"), F.lit(2)) == 0)
    known = landed(known.select("stratum", *RULES, "quality", "held"), "judged")
    spread = [i / risk.candidates for i in range(risk.candidates + 1)]
    quantiles = known.where("not held and quality = 0").groupBy("stratum").agg(*(F.percentile_approx(c, spread, 10_000).alias(c) for c in RULES)).collect()
    cuts = {}
    for r in quantiles:
        for c, sign in RULES.items():
            # just short of the quantile, so that it lies beyond
            grid = np.unique(np.array(r[c]) * (1 - 1e-9) if sign > 0 else np.array(r[c]) * (1 + 1e-9))
            cuts[r["stratum"], c] = grid[::-1] if sign > 0 else grid
    rules = Rules(cuts, {}, {})

    def count(batches):
        for batch in batches:
            for stratum, own in batch.groupby("stratum"):
                for c, sign in RULES.items():
                    grid = rules.cuts.get((stratum, c))
                    if grid is not None and len(grid):
                        at = np.searchsorted(-sign * grid, -sign * own[c].to_numpy(), side="right")
                        for quality in (0, 1):
                            n = np.bincount(at[own["quality"].to_numpy() == quality], minlength=len(grid) + 1)
                            yield batch.__class__({"stratum": stratum, "rule": c, "k": np.arange(len(n)), "quality": quality, "n": n})

    tallies = known.where("not held").mapInPandas(count, "stratum string, rule string, k int, quality int, n bigint").groupBy("stratum", "rule", "k", "quality").agg(F.sum("n").alias("n")).collect()
    counts: dict[tuple[str, str, int], np.ndarray] = {}
    for r in tallies:
        own = counts.setdefault((r["stratum"], r["rule"], r["quality"]), np.zeros(len(cuts[r["stratum"], r["rule"]]) + 1))
        own[r["k"]] += r["n"]
    for stratum in {s for s, _ in cuts}:
        offers = []
        for c in RULES:
            bad, good = (counts.get((stratum, c, q), np.zeros(len(cuts[stratum, c]) + 1)) for q in (0, 1))
            cost = (np.cumsum(good)[:-1] + 0.5) / (good.sum() + 1) / ((np.cumsum(bad)[:-1] + 0.5) / (bad.sum() + 1))
            cost = np.maximum.accumulate(cost)  # a stricter cutoff comes no earlier than a milder one
            offered = int((cost * risk.lift <= 1).sum())
            cuts[stratum, c] = cuts[stratum, c][:offered]
            offers += [(cost[k], k, c) for k in range(offered)]
        rules.steps.update({(stratum, c): np.zeros(len(cuts[stratum, c]), dtype=np.int64) for c in RULES})
        for step, (_, k, c) in enumerate(sorted(offers)):
            rules.steps[stratum, c][k] = step

    drop_costly_steps(rules, known.where("not held"), risk)
    held = known.where("held and quality = 1").groupBy("stratum", first_step(rules)["step"].alias("step")).agg(F.count("*").alias("n")).collect()
    strata = sorted({s for s, _ in cuts})
    for stratum in strata:
        own = {r["step"]: r["n"] for r in held if r["stratum"] == stratum}
        total, rejected = sum(own.values()), 0
        rules.certified[stratum] = -1
        for step in sorted(k for (s, _), v in rules.steps.items() if s == stratum for k in v.tolist()):
            rejected += own.get(step, 0)
            if upper_bound(rejected, total, risk.error / len(strata)) > risk.false_rejection:
                break
            rules.certified[stratum] = step
    return rules


def drop_costly_steps(rules: Rules, known: DataFrame, risk: Risk) -> None:
    """Drop the cutoffs whose own step, after those before it, catches too few more bad for the good it costs."""
    rows = known.groupBy("stratum", "quality", first_step(rules)["step"].alias("step")).agg(F.count("*").alias("n")).collect()
    counts = {(r["stratum"], r["quality"], r["step"]): r["n"] for r in rows}
    totals = {key: sum(n for (s, q, _), n in counts.items() if (s, q) == key) for key in {(s, q) for s, q, _ in counts}}
    for (stratum, c), steps in rules.steps.items():
        bad, good = (np.array([counts.get((stratum, q, k), 0) for k in steps.tolist()]) / max(totals.get((stratum, q), 0), 1) for q in (0, 1))
        worth = (bad > 0) & (bad >= risk.lift * good)
        rules.cuts[stratum, c], rules.steps[stratum, c] = rules.cuts[stratum, c][worth], steps[worth]


def judge(features: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, the base numbers, base_failed, kept and the rule that rejects (null if none of these does)."""
    last = F.create_map(*[x for s, k in sorted(rules.certified.items()) for x in (F.lit(s), F.lit(k))]) if rules.certified else F.create_map().cast("map<string,int>")
    found = features.withColumn("_first", first_step(rules)).withColumn("base_failed", base_failed())
    rejected = (F.col("_first.step") >= 0) & (F.col("_first.step") <= F.coalesce(last[F.col("stratum")], F.lit(-1)))
    names = F.array(*(F.lit(c) for c in RULES))
    return found.select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"),
        F.when(rejected, F.get(names, F.col("_first.rule"))).alias("rule"),
    )


def apply_quality_rules(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Learn the rules and judge every row of ``docs``; texts are measured once. Without labels only the base rules hold."""
    features = landed(measured(docs), "features")
    return judge(features, learn_rules(features, labels, risk))
