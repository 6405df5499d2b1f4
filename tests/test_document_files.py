"""Documents of a run as files: small, written side by side, and read with one parse of each line."""

from __future__ import annotations

import datetime as dt
import os
import threading

from pyspark.sql import functions as F

from assayer.operators.documents import document_rows
from assayer.plans import batch
from assayer.plans.batch import Run, process_all
from assayer.sinks.documents import read_documents, write_documents

RUN_AT = dt.datetime(2024, 2, 1)
KIND = "_index string, _id string, _source string"


def rows_of(df):
    return sorted((r["_index"], r["_id"] or "", r["_source"]) for r in df.collect())


def test_documents_are_read_as_they_were_written(spark, tmp_path):
    """With and without ids, with the word _id in their content, and beside plain lines that were written earlier."""
    odd = ['{"_id":"no"}', "_id", '"_id"', 'a\n\r\t"\\ é 語 😀', "", '{"_source":"x","_id":"y"}', "{", "null"]
    path, plain = str(tmp_path / "docs"), [("i", f"k{n}", f"old {n}") for n in range(3)] + [("j", None, s) for s in odd]
    earlier = spark.createDataFrame(plain, KIND).select("_index", F.to_json(F.struct("_id", "_source")).alias("value"))
    earlier.write.partitionBy("_index").text(f"{path}/_run=a")
    new = [("i", "k1", '{"_id":"k2"}'), ("i", '"_id"', "_id")] + [("i", None, s) for s in odd]
    assert write_documents(spark.createDataFrame(new, KIND), path, "b/1") == (len(new), 0)
    expected = [("i", "k0", "old 0"), ("i", "k2", "old 2"), *new, *plain[3:]]
    assert rows_of(read_documents(spark, path)) == sorted((i, k or "", s) for i, k, s in expected)
    assert spark.read.text(path).count() == len(plain) + len(new)


def test_names_that_repeat_in_every_line_take_little_room(spark, tmp_path):
    records = spark.range(5000).select(F.xxhash64("id").alias("number"), *(F.lit(0.5).alias(f"metric_{n}") for n in range(12)))
    rows = document_rows(records, F.lit("i"))
    write_documents(rows, str(tmp_path))
    stored = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path) for f in files)
    assert stored < rows.agg(F.sum(F.length("_source"))).first()[0] / 3


def test_lines_without_an_id_are_parsed_by_the_scan(spark, tmp_path, capsys):
    write_documents(document_rows(spark.range(10), F.lit("i")), str(tmp_path))
    read_documents(spark, str(tmp_path)).explain("extended")
    scans = [line for line in capsys.readouterr().out.split("== Physical Plan ==")[1].splitlines() if "from_json" in line or "FileScan" in line]
    filters = [line for line in scans if "Filter (" in line]
    assert any("FileScan json" in line for line in scans)
    assert filters and all('Contains(value' in line for line in filters)


def feeds(spark, tmp_path, names):
    spark.range(30).write.parquet(str(tmp_path / "in"))
    return {"file_sources": [{"name": n, "type": "parquet", "path": str(tmp_path / "in")} for n in names]}


def run_of(tmp_path):
    return Run("r", RUN_AT, {t: str(tmp_path / t) for t in ("gold", "silver", "bronze", "rejected")}, documents_path=str(tmp_path / "docs"))


def test_documents_of_sources_are_written_side_by_side(spark, tmp_path, monkeypatch):
    both, write = threading.Barrier(2, timeout=60), batch.write_documents

    def met(*args):
        both.wait()
        return write(*args)

    monkeypatch.setattr(batch, "write_documents", met)
    results = process_all(spark, feeds(spark, tmp_path, ("a", "b")), run_of(tmp_path), at_once=2).collect()
    assert [r["report_error"] for r in results] == [None, None]
    assert read_documents(spark, str(tmp_path / "docs")).count() == 60


def test_documents_that_cannot_be_written_are_one_sources_own(spark, tmp_path, monkeypatch):
    write = batch.write_documents

    def broken(rows, *args):
        if rows.where("_index like '%_b_%'").limit(1).count():
            raise OSError("disk full")
        return write(rows, *args)

    monkeypatch.setattr(batch, "write_documents", broken)
    results = process_all(spark, feeds(spark, tmp_path, ("a", "b", "c")), run_of(tmp_path)).collect()
    assert {r["source_name"]: r["report_error"] for r in results} == {"a": None, "b": "documents: disk full", "c": None}
    assert read_documents(spark, str(tmp_path / "docs")).count() == 60


def test_sources_of_one_index_are_written_in_their_order(spark, tmp_path, monkeypatch):
    running, most, write = [], [], batch.write_documents

    def watched(*args):
        running.append(1)
        most.append(len(running))
        try:
            return write(*args)
        finally:
            running.pop()

    monkeypatch.setattr(batch, "write_documents", watched)
    process_all(spark, feeds(spark, tmp_path, ("Feed", "feed")), run_of(tmp_path)).collect()
    assert most == [1, 1]
    kept = read_documents(spark, str(tmp_path / "docs")).select(F.get_json_object("_source", "$.source_name").alias("s"))
    assert {r["s"] for r in kept.collect()} == {"feed"}
