"""The document store: merges against a plain dictionary, untouched files, versions and rival writers."""

from __future__ import annotations

import os
import random

import pytest

from assayer.sinks import document_store as documents

CHANGES = "_index string, _id string, _source string, at int"


def held(spark, store, version=None):
    return sorted(tuple(r) for r in documents.read_store(spark, store, version).collect())


def files(store):
    return {f"{d}/{f}" for d, _, fs in os.walk(f"{store}/data") for f in fs if f.endswith(".parquet")}


def test_merges_do_what_a_dictionary_does(spark, tmp_path):
    rng, store, plain, past = random.Random(2), str(tmp_path / "s"), {}, []
    for run in range(4):
        changes = [(rng.choice("ab"), str(rng.randint(0, 60)), rng.choice([None, "x", "y"]) and f"{run} {at}", at) for at in range(150)]
        rng.shuffle(changes)
        expected, last = dict.fromkeys(documents.OUTCOMES, 0), {}
        for index, key, source, _ in sorted(changes, key=lambda c: c[3]):
            last[index, key] = source
        for key, source in last.items():
            there = key in plain
            expected["deleted" if source is None and there else "not_found" if source is None else "updated" if there else "created"] += 1
            if source is None:
                plain.pop(key, None)
            else:
                plain[key] = source
        assert documents.merge_documents(spark, store, spark.createDataFrame(changes, CHANGES), ["at"], buckets=5) == expected | {"errors": 0}
        past.append(sorted((*k, v) for k, v in plain.items()))
        assert held(spark, store) == past[-1]
    assert held(spark, store, 2) == past[1] and documents.versions(spark, store) == [1, 2, 3, 4]
    assert documents.vacuum(spark, store) > 0 and documents.vacuum(spark, store) == 0
    assert held(spark, store) == past[-1]


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    store = str(tmp_path / "s")
    documents.merge_documents(spark, store, spark.range(400).selectExpr("'i' as _index", "id as _id", "'one' as _source"), buckets=8)
    before = files(store)
    assert documents.merge_documents(spark, store, spark.createDataFrame([("i", "7", "two")], "_index string, _id string, _source string"))["updated"] == 1
    added = files(store) - before
    assert before <= files(store) and len({f.split("bucket=")[1].split("/")[0] for f in added}) == 1
    assert documents.vacuum(spark, store) == 1
    assert len(before & files(store)) == len(before) - 1
    assert sorted(r[2] for r in held(spark, store)) == ["one"] * 399 + ["two"]


def test_nothing_empty_and_without_id(spark, tmp_path):
    store, none = str(tmp_path / "s"), "_index string, _id string, _source string"
    assert held(spark, store) == [] and documents.vacuum(spark, store) == 0
    assert documents.merge_documents(spark, store, spark.createDataFrame([], none)) == dict.fromkeys((*documents.OUTCOMES, "errors"), 0)
    counted = documents.merge_documents(spark, store, spark.createDataFrame([("i", None, "x"), ("i", None, "x"), (None, "1", "y")], none))
    assert (counted["created"], counted["errors"]) == (2, 1)
    assert [r[2] for r in held(spark, store)] == ["x", "x"]
    everything = documents.read_store(spark, store).selectExpr("_index", "_id", "cast(null as string) as _source")
    assert documents.merge_documents(spark, store, everything)["deleted"] == 2 and held(spark, store) == []
    assert documents.merge_documents(spark, store, spark.createDataFrame([("i", "1", "z")], none), buckets=9)["created"] == 1
    assert documents.layout(spark, store)[:2] == (3, 64)
    with pytest.raises(ValueError, match="no version 9"):
        documents.read_store(spark, store, 9)


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    store, rows = str(tmp_path / "s"), spark.createDataFrame([("i", "1", "x")], "_index string, _id string, _source string")
    documents.merge_documents(spark, store, rows)
    commit = documents.commit_version
    rival = []

    def late(*args):
        if not rival:
            rival.append(True)
            documents.merge_documents(spark, store, spark.createDataFrame([("i", "2", "rival")], "_index string, _id string, _source string"))
        commit(*args)

    monkeypatch.setattr(documents, "commit_version", late)
    with pytest.raises(documents.VersionTaken):
        documents.merge_documents(spark, store, spark.createDataFrame([("i", "3", "late")], "_index string, _id string, _source string"))
    assert held(spark, store) == [("i", "1", "x"), ("i", "2", "rival")]
    documents.claim_path(spark, f"{store}/claims/3")  # a writer that died before its commit
    with pytest.raises(documents.VersionTaken):
        documents.merge_documents(spark, store, rows)
    assert documents.release_claim(spark, store)
    assert documents.merge_documents(spark, store, rows)["updated"] == 1
