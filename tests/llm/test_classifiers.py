"""Toxicity and language: accuracy on documents kept from learning, and odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from assayer.llm.langid import FAMILIES, LanguageModel, fit_languages, fit_machine, grams, identify_language
from assayer.llm.queries import QUERIES
from assayer.llm.toxicity import Features, LabelModel, Settings, bits_to_votes, drop_toxic, fit_label_model, fit_linear, fit_toxicity, score_toxicity
from tests.oracle import DATA


def bucket(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_toxicity_on_documents_it_has_not_seen(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, f"{DATA}/sf0.1").collect()
    assert all(r.held_out == (bucket(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    found = sum(p for t, p in held if t == 1) / sum(t == 1 for t, _ in held)
    wrong = sum(p for t, p in held if t == 0) / sum(t == 0 for t, _ in held)
    assert found > 0.8 and wrong < 0.01, (found, wrong)


def test_label_model_finds_accuracies_and_copies_among_voters():
    rng = np.random.default_rng(5)
    y = rng.random(20_000) < 0.2
    votes = np.stack([np.where(y, rng.random(len(y)) < hit, rng.random(len(y)) < miss) for hit, miss in ((0.9, 0.05), (0.8, 0.1), (0.7, 0.02), (0.5, 0.5))], 1).astype(int)
    votes = np.column_stack((votes, np.where(rng.random(len(y)) < 0.95, votes[:, 0], 1 - votes[:, 0])))  # leans on the first
    gold = np.where(rng.random(len(y)) < 0.05, y, -1).astype(int)
    keys, weight = np.unique(np.column_stack((votes, gold)), axis=0, return_counts=True)
    model = fit_label_model(keys[:, :5], keys[:, 5], weight.astype(float), 0.97)
    assert abs(model.prior - 0.2) < 0.03
    assert (model.parents[4], model.parents[0]) in ((0, -1), (0, 4)) or model.parents[0] == 4 or model.parents[4] == 0
    p = model.posterior(votes, np.full(len(y), -1), 0.97)
    rates = [[(w * votes[:, j]).sum() / w.sum() for w in (p, 1 - p)] for j in range(4)]  # accuracies as the model sees them
    assert np.allclose(rates, [(0.9, 0.05), (0.8, 0.1), (0.7, 0.02), (0.5, 0.5)], atol=0.05)
    assert ((p > 0.5) == y).mean() > 0.94


def test_linear_model_learns_soft_targets():
    rows = [np.array([0, 2]), np.array([1, 2])] * 50
    w, bias = fit_linear(rows, np.array([0.95, 0.05] * 50), 3)
    assert w[0] + bias + w[2] > 1 > -1 > w[1] + bias + w[2]


def test_votes_come_from_words_beginnings_and_style():
    features = Features([b"bad", b"^vil"], {b"bad": 0, b"^vil": 1}, 2)
    assert features(b"A Bad villain")[1] == 0b11
    assert features(b"LOUD WORDS here!!")[1] == 0b1100
    assert bits_to_votes(np.array([5]), 4).tolist() == [[1, 0, 1, 0]]


def test_odd_documents(spark, odd_docs, no_docs, some_labels):
    model = fit_toxicity(odd_docs, some_labels)
    rows = score_toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert drop_toxic(odd_docs, model).columns == odd_docs.columns
    nothing = fit_toxicity(no_docs, some_labels.limit(0), Settings())
    assert score_toxicity(no_docs, nothing).collect() == [] and score_toxicity(odd_docs, nothing).where("predicted = 1").count() == 0


def test_labels_and_ids_are_no_input_of_a_score(spark, tables):
    docs = tables["documents"]
    model = fit_toxicity(docs, tables["labels"])
    scores = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    moved = docs.selectExpr("doc_id + 1000000 AS doc_id", "text", "'xx' AS lang")
    assert {r.doc_id - 1_000_000: r.score for r in score_toxicity(moved, model).collect()} == pytest.approx(scores)


def test_language_on_documents_it_has_not_seen(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op2_language_id"](spark, f"{DATA}/sf0.01").collect()
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.98
    assert all(r.held_out == (bucket(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)


def test_texts_without_letters_have_no_language(spark, odd_docs, no_docs):
    model = fit_languages(odd_docs)
    rows = identify_language(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (3, 4, 5, 9)] == ["und"] * 4
    assert by_id[6].lang_pred in ("en",)
    empty = fit_languages(no_docs)
    assert identify_language(odd_docs, empty).where("lang_pred != 'und'").count() == 0 and identify_language(no_docs, empty).count() == 0


def test_pairs_vote_within_the_family():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = fit_machine(x, np.where(x[:, 0] > 0, 1.0, -1.0).astype(np.float32), rounds=400)
    assert (((x @ w[:-1] + w[-1]) > 0) == (x[:, 0] > 0)).mean() > 0.95
    zero = np.zeros((1, 9), dtype=np.float32)
    model = LanguageModel(["only"], {"only": ["a", "b"]}, zero, {("a", "b"): w})
    names, sure = model.predict(x)
    assert set(names) == {"a", "b"} and ((sure >= 0.5) & (sure <= 1)).all()
    assert "fr" in FAMILIES["romance"] and abs(float(np.linalg.norm(grams(b"abc def"))) - 1) < 1e-5 and grams(b"").shape == (4096,)
