"""Toxicity by weak supervision.

Voters (mined word lists, mined word-beginning patterns, style patterns) vote on whole texts. A generative
label model, fitted by expectation maximisation, estimates how accurate each voter is and which voters
depend on each other; a linear classifier is trained on the labels' posteriors and scores all texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import held_out, per_batch, raw, sampled

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
SHOUT = re.compile(rb"[A-Z]{4,}[^a-z]{0,4}[A-Z]{4,}")
BANGS = re.compile(rb"!{2,}")
PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit: labelled rows sampled, terms kept, voters of each kind, least documents of a term,
    least log odds (2.6 standard errors taken off) of a feature and of a voter's term, trust in a labeller."""

    rows: int = 20_000
    terms: int = 8_000
    lexicons: int = 6
    patterns: int = 4
    least: int = 3
    surely: float = 0.3
    accusing: float = 1.0
    gold: float = 0.97


@dataclass
class LabelModel:
    """P(label) and P(vote | label, vote of the parent voter), a tree of dependent voters for either label."""

    prior: float = 0.1
    parents: list[int] = field(default_factory=list)
    tables: np.ndarray | None = None  # voter, label, parent's vote -> P(vote = 1)

    def likelihood(self, votes: np.ndarray) -> np.ndarray:
        """log P(votes, label) for each row and label."""
        out = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, parent in enumerate(self.parents):
            seen = votes[:, parent] if parent >= 0 else np.zeros(len(votes), dtype=int)
            for y in (0, 1):
                p = self.tables[j, y, seen]
                out[:, y] += np.where(votes[:, j] == 1, np.log(p), np.log1p(-p))
        return out

    def posterior(self, votes: np.ndarray, gold: np.ndarray, trust: float) -> np.ndarray:
        """P(label = 1) given the votes and, where it is 0 or 1, a labeller's judgement trusted so far."""
        joint = self.likelihood(votes)
        said = np.array([[0.0, 0.0], np.log([trust, 1 - trust]), np.log([1 - trust, trust])])[gold + 1]
        joint = joint + said
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -50, 50)))


def dependencies(votes: np.ndarray, weight: np.ndarray, p: np.ndarray, least: float) -> list[int]:
    """Each voter's parent (-1: none): the strongest tree of mutual information given the label."""
    m = votes.shape[1]
    strength = np.zeros((m, m))
    for y in (0, 1):
        w = weight * (p if y else 1 - p)
        total = max(w.sum(), 1e-9)
        for a in (0, 1):
            for b in (0, 1):
                left, right = (votes == a).astype(float), (votes == b).astype(float)
                both = (left * w[:, None]).T @ right / total + 1e-9
                one, two = (left * w[:, None]).sum(0) / total + 1e-9, (right * w[:, None]).sum(0) / total + 1e-9
                strength += total / max(weight.sum(), 1e-9) * both * np.log(both / np.outer(one, two))
    parents, inside, left = [-1] * m, {0}, set(range(1, m))
    while left:
        a, b = max(((i, j) for i in inside for j in left), key=lambda pair: strength[pair])
        if strength[a, b] > least:
            parents[b] = a
        inside.add(b)
        left.discard(b)
    return parents


def fit_label_model(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray, trust: float, rounds: int = 500) -> LabelModel:
    """Expectation maximisation over distinct vote patterns; ``gold`` is -1 where nobody labelled."""
    model, m = LabelModel(), votes.shape[1]
    known = gold >= 0
    rate = (weight * (gold == 1)).sum() / max((weight * known).sum(), 1e-9)
    p = np.where(gold >= 0, np.where(gold == 1, trust, 1 - trust), np.clip(rate + 0.3 * (votes.sum(1) > 1), 0.01, 0.9))
    for turn in range(rounds):
        model.prior = float(np.clip((weight * p).sum() / max(weight.sum(), 1e-9), 1e-4, 0.9999))
        if turn == 0:
            # only where the label is known does a common cause not look like a dependency
            seen = weight * known
            model.parents = dependencies(votes, seen, p, max(2e-3, 10 / max(seen.sum(), 1.0))) if m else []
        model.tables = np.full((m, 2, 2), 0.5)
        for j, parent in enumerate(model.parents):
            seen = votes[:, parent] if parent >= 0 else np.zeros(len(votes), dtype=int)
            for y in (0, 1):
                w = weight * (p if y else 1 - p)
                for s in (0, 1):
                    here = w * (seen == s)
                    model.tables[j, y, s] = ((here * votes[:, j]).sum() + 0.5) / (here.sum() + 1.0)
        model.tables = np.clip(model.tables, 1e-6, 1 - 1e-6)
        last, p = p, model.posterior(votes, gold, trust)
        if turn and np.abs(p - last).max(initial=0.0) < 1e-6:
            break
    return model


def fit_linear(rows: list[np.ndarray], target: np.ndarray, width: int, rounds: int = 1000) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features with soft targets; weight decay; full-batch gradients with momentum."""
    flat = np.concatenate([*rows, np.empty(0, dtype=np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rate = float(np.clip(target.mean(), 1e-4, 1 - 1e-4)) if len(target) else 0.01
    w, bias, speed, pull = np.zeros(width), math.log(rate / (1 - rate)), np.zeros(width), 0.0
    heavy = np.bincount(flat, minlength=width) / max(len(rows), 1)
    step = 1.0 / (0.25 * heavy * 12 + 1e-3)  # a diagonal bound of the curvature
    for _ in range(rounds):
        score = bias + np.bincount(owner, w[flat], minlength=len(rows))
        gap = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - target
        grad = np.bincount(flat, gap[owner], minlength=width) / max(len(rows), 1) + 2e-5 * w
        speed = 0.9 * speed - 0.1 * step * grad
        pull = 0.9 * pull - 0.1 * 4.0 * (gap.mean() if len(gap) else 0.0)
        w, bias = w + speed, bias + pull
    return w, bias


def terms_of(text: bytes) -> set[bytes]:
    """The distinct words of a text and their beginnings (marked ``^``)."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({b"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES))


class Features:
    """Term numbers and votes of a text. Votes 0.. are word lists, then beginnings, then shouting and bangs."""

    def __init__(self, terms: list[bytes], voters: dict[bytes, int], count: int):
        self.number = {t: i for i, t in enumerate(terms)}
        self.votes = [voters.get(t, -1) for t in terms]
        self.count = count
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        found = self.seen.get(word)
        if found is None:
            keys = [word, *(b"^" + word[:n] for n in PREFIXES if len(word) > n)]
            found = tuple(self.number[k] for k in keys if k in self.number)
            if len(self.seen) < 300_000:
                self.seen[word] = found
        return found

    def __call__(self, text: bytes) -> tuple[list[int], int]:
        """(numbers of the terms and, after them, of the mined voters that found one; votes as bits)"""
        ids = sorted({i for w in set(WORD.findall(text.lower())) for i in self.of_word(w)})
        bits = 0
        for i in ids:
            if self.votes[i] >= 0:
                bits |= 1 << self.votes[i]
        bits |= (SHOUT.search(text) is not None) << self.count
        bits |= (BANGS.search(text) is not None) << (self.count + 1)
        ids.extend(len(self.votes) + j for j in range(self.count) if bits >> j & 1)
        return ids, bits


@dataclass
class Toxicity:
    """A fitted scorer; picklable and small: ``terms`` are bounded by the settings."""

    terms: list[bytes]
    voters: dict[bytes, int]
    count: int
    weights: np.ndarray
    bias: float
    label_model: LabelModel

    def score(self, text: Column) -> Column:
        """A column of scores for a column of UTF-8 bytes."""
        model, state = self, {}

        @F.pandas_udf("double")
        def scores(texts):
            import pandas as pd

            features = state.setdefault("features", Features(model.terms, model.voters, model.count))
            found = [model.bias + float(model.weights[features(t)[0]].sum()) for t in texts]
            return pd.Series(1 / (1 + np.exp(-np.clip(np.array(found, dtype=float), -50, 50))))

        return scores(text)


def bits_to_votes(bits: np.ndarray, voters: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(voters)[None, :]) & 1


def fit_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Toxicity:
    """Fit on the documents that are not held out.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0, 1; anything else is no label). Terms and the
    classifier come from a sample of about ``settings.rows`` labelled documents, chosen by a hash of the id.
    The label model's votes are counted over all documents that are not held out; there are at most 2^12
    different vote patterns. Without labels nothing is learned and every score is low.
    """
    judged = labels.where(F.col("toxic").isin(0, 1) & ~held_out(5, 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("gold"))
    sample = sampled(judged, "doc_id", settings.rows, judged.count())
    training = docs.where(~held_out(5, 0)).select("doc_id", raw().alias("text"))
    chosen = training.join(F.broadcast(sample), "doc_id").select("text", "gold")  # bounded by settings.rows

    term_schema = pa.schema([("term", pa.binary()), ("gold", pa.int32()), ("n", pa.int64())])

    def count_terms(batches):
        for batch in batches:
            counts: dict[tuple[bytes, int], int] = {}
            for text, gold in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for term in terms_of(text):
                    counts[term, gold] = counts.get((term, gold), 0) + 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())], schema=term_schema)

    sizes = {r["gold"]: r["n"] for r in sample.groupBy("gold").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    by_term = chosen.mapInArrow(count_terms, "term binary, gold int, n bigint").groupBy("term").agg(
        F.sum(F.when(F.col("gold") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("gold") == 0, F.col("n")).otherwise(0)).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (F.lit(float(bad)) + 1)) - F.log((F.col("good") + 0.5) / (F.lit(float(good)) + 1))
    surely = F.abs(odds) - 2.6 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    told = by_term.where(F.col("bad") + F.col("good") >= settings.least).select("term", (F.signum(odds) * surely).alias("sure"), surely.alias("size"))
    kept = told.where(F.col("size") >= settings.surely).orderBy(F.desc("size"), "term").limit(settings.terms).collect()
    terms = [bytes(r["term"]) for r in kept]
    accusing = [bytes(r["term"]) for r in kept if r["sure"] >= settings.accusing]
    words = [t for t in accusing if t[:1] != b"^"]
    starts = [t for t in accusing if t[:1] == b"^"]
    count = settings.lexicons + settings.patterns
    voters = {t: i % settings.lexicons for i, t in enumerate(words)} | {t: settings.lexicons + i % settings.patterns for i, t in enumerate(starts)}

    def features_of(texts, golds=None):
        features = features_of.__dict__.get("made") or features_of.__dict__.setdefault("made", Features(terms, voters, count))
        found = [features(t) for t in texts]
        return {"ids": [x for x, _ in found], "bits": [b for _, b in found], "gold": golds or []}

    def count_votes(batches):
        features, counts = Features(terms, voters, count), {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                bits = features(text)[1]
                counts[bits] = counts.get(bits, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["bits", "n"])

    everywhere = training.select("text").mapInArrow(count_votes, "bits int, n bigint").groupBy("bits").agg(F.sum("n").alias("n")).collect()
    schema = pa.schema([("ids", pa.list_(pa.int32())), ("bits", pa.int32()), ("gold", pa.int32())])
    rows = chosen.mapInArrow(per_batch(features_of, schema), "ids array<int>, bits int, gold int").collect()

    labelled = [(r["bits"], r["gold"]) for r in rows]
    patterns: dict[tuple[int, int], float] = {(r["bits"], -1): float(r["n"]) for r in everywhere}
    for key in labelled:
        patterns[key] = patterns.get(key, 0.0) + 1.0
    keys = sorted(patterns)
    bits, gold = np.array([k[0] for k in keys], dtype=int), np.array([k[1] for k in keys], dtype=int)
    model = fit_label_model(bits_to_votes(bits, count + 2), gold, np.array([patterns[k] for k in keys]), settings.gold)
    target = model.posterior(bits_to_votes(np.array([b for b, _ in labelled], dtype=int), count + 2), np.array([g for _, g in labelled], dtype=int), settings.gold)
    weights, bias = fit_linear([np.array(r["ids"], dtype=np.int64) for r in rows], target, len(terms) + count)
    return Toxicity(terms, voters, count, weights, bias, model)


def score_toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, repeated rows included; null texts count as empty."""
    scored = docs.select("doc_id", held_out(5, 0).alias("held_out"), model.score(raw()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns stay as they are."""
    return docs.where(model.score(raw()) < 0.5)
