"""Language identification in two steps: the family first, then pairs of languages within it.

Families are told apart by one linear support vector machine each, the languages of a family by one machine
for every two of them. Features are hashed 2-, 3- and 4-grams of the bytes of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import LOWER, UPPER, held_out, per_batch, raw

# Families by language code; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
}
WIDTH_BITS = 12
_TO = bytes.maketrans(UPPER.encode() + bytes(c for c in range(128) if not chr(c).isalpha()), LOWER.encode() + b" " * sum(not chr(c).isalpha() for c in range(128)))


def grams(text: bytes) -> np.ndarray:
    """Square roots of the counts of a text's hashed byte n-grams, scaled to length 1."""
    b = np.frombuffer(b" " + text.translate(_TO) + b" ", dtype=np.uint8).astype(np.uint32)
    two = b[:-1] | (b[1:] << 8)
    parts = [two]
    if len(b) > 2:
        three = two[:-1] | (b[2:] << 16)
        parts.append(three + np.uint32(0x5BD1E995))
        if len(b) > 3:
            parts.append((three[:-1] | (b[3:] << 24)) ^ np.uint32(0x9E3779B9))
    codes = np.concatenate(parts) * np.uint32(2654435761)
    x = np.sqrt(np.bincount(codes >> np.uint32(32 - WIDTH_BITS), minlength=1 << WIDTH_BITS)).astype(np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


def fit_machine(x: np.ndarray, sign: np.ndarray, decay: float = 1e-4, rounds: int = 120) -> np.ndarray:
    """A linear machine (last weight: bias) with squared hinge loss, by accelerated gradients; classes weigh the same."""
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, dtype=np.float32)
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        gap = np.maximum(0, 1 - sign * (x @ ahead[:-1] + ahead[-1]))
        pull = (-2 * share * sign * gap).astype(np.float32)
        grad = np.append(x.T @ pull, pull.sum()) + decay * np.append(ahead[:-1], 0)
        new = ahead - 0.24 * grad
        faster = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        ahead = (new + (momentum - 1) / faster * (new - w)).astype(np.float32)
        w, momentum = new.astype(np.float32), faster
    return w


def family_of(lang: str, families: dict[str, tuple[str, ...]]) -> str:
    return next((f for f, members in families.items() if lang in members), lang)


@dataclass
class LanguageModel:
    """Machines by family and by pair; small: 4096 weights each."""

    families: list[str]
    members: dict[str, list[str]]
    family_machines: np.ndarray
    pair_machines: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row and how sure that is (0 to 1)."""
        if not self.families:
            return ["und"] * len(x), np.zeros(len(x))
        if len(self.families) > 1:
            near = 1 / (1 + np.exp(-4 * (x @ self.family_machines[:, :-1].T + self.family_machines[:, -1])))
            near = near / np.maximum(near.sum(1, keepdims=True), 1e-12)
        else:
            near = np.ones((len(x), 1))
        family, out, sure = near.argmax(1), [""] * len(x), near.max(1).astype(float)
        for k, name in enumerate(self.families):
            rows, langs = np.nonzero(family == k)[0], self.members[name]
            if not len(rows):
                continue
            wins, odds = np.zeros((len(rows), len(langs))), np.ones((len(rows), len(langs)))
            for i, j in combinations(range(len(langs)), 2):
                w = self.pair_machines[langs[i], langs[j]]
                p = 1 / (1 + np.exp(-4 * (x[rows] @ w[:-1] + w[-1])))
                wins[:, i] += p >= 0.5
                wins[:, j] += p < 0.5
                odds[:, i] *= p
                odds[:, j] *= 1 - p
            best = (wins + odds / np.maximum(odds.sum(1, keepdims=True), 1e-12) * 0.5).argmax(1)
            for row, b in zip(rows, best, strict=True):
                out[row] = langs[b]
            sure[rows] *= odds[np.arange(len(rows)), best] / np.maximum(odds.sum(1), 1e-12)
        return out, np.clip(sure, 0, 1)


def fit_languages(docs: DataFrame, families: dict[str, tuple[str, ...]] = FAMILIES, rows_per_language: int = 1000) -> LanguageModel:
    """Learn from text and non-null lang of the rows that are not held out.

    Of each language about ``rows_per_language`` rows are sampled by a hash of the id; their whole texts count.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(5, 0))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel([], {}, np.zeros((0, (1 << WIDTH_BITS) + 1), dtype=np.float32), {})
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(1_000_000 * min(1, rows_per_language / n))))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")]).select("lang", raw().alias("text"))
    schema = pa.schema([("lang", pa.string()), ("x", pa.binary())])
    found = chosen.mapInArrow(per_batch(lambda langs, texts: {"lang": langs, "x": [grams(t).astype(np.float16).tobytes() for t in texts]}, schema, 256), "lang string, x binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16).astype(np.float32) for r in found])
    lang = np.array([r["lang"] for r in found])
    members: dict[str, list[str]] = {}
    for name in sorted(set(lang)):
        members.setdefault(family_of(name, families), []).append(name)
    names = sorted(members)
    family = np.array([family_of(name, families) for name in lang])
    machines = np.stack([fit_machine(x, np.where(family == f, 1.0, -1.0).astype(np.float32)) for f in names])
    pairs = {}
    for langs in members.values():
        for a, b in combinations(langs, 2):
            own = (lang == a) | (lang == b)
            pairs[a, b] = fit_machine(x[own], np.where(lang[own] == a, 1.0, -1.0).astype(np.float32))
    return LanguageModel(names, members, machines, pairs)


def predict_language(model: LanguageModel, text: Column, letters: Column) -> Column:
    """struct<lang, score> for UTF-8 bytes; ``und`` with score 0 where there is no letter."""

    @F.pandas_udf("lang string, score double")
    def predicted(texts, lettered):
        import pandas as pd

        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        rows = [i for i, yes in enumerate(lettered) if yes]
        for start in range(0, len(rows), 256):
            part = rows[start : start + 256]
            names, sure = model.predict(np.stack([grams(texts.iloc[i]) for i in part]))
            for i, name, s in zip(part, names, sure, strict=True):
                langs[i], scores[i] = name, s
        return pd.DataFrame({"lang": langs, "score": scores})

    return predicted(text, letters)


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; null texts and texts without a letter are ``und``."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    guessed = docs.select("doc_id", held_out(5, 0).alias("held_out"), predict_language(model, raw(), letters).alias("guess"))
    return guessed.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))
