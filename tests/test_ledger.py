"""Incremental loads that know what they took up by a ledger."""

import datetime as dt

import pytest

from assayer.plans import batch
from assayer.plans.batch import Run, process_all
from assayer.session import list_folders
from assayer.sources import ledger
from assayer.sources.incremental import advance_high_water, load_high_water

SCHEMA = "id int, other string, t timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, n)


ARRIVALS = [
    [],
    [(100, "a", None), (100, "b", None)],  # nothing with a time yet
    [(i, "a", day(i)) for i in range(1, 5)] + [(101, None, None)],
    [(i, "a", day(i)) for i in range(5, 8)] + [(40, "a", day(4)), (102, "", None)],  # one of the mark's own moment
    [],
    [(70, "a", day(7)), (4, "a", day(8)), (103, None, None)],  # a late tie, and a changed row
    [(71, "a", day(8)), (71, "a", day(8))],  # rows that are repeated in one load all count
]


@pytest.mark.parametrize(("columns", "parts"), [(["id"], 1), (["id", "other"], 2), (["t", "other", "id"], 16)])
def test_every_row_is_loaded_once(spark, tmp_path, monkeypatch, columns, parts):
    monkeypatch.setattr(ledger, "PARTS", parts)
    state, there, mark = str(tmp_path), [], None
    arrivals = [[(0, "x", None), *wave] if i == 1 else wave for i, wave in enumerate(ARRIVALS)]
    for wave in arrivals:
        there += wave
        df = spark.createDataFrame(there, SCHEMA)
        known = ledger.load_ledger(spark, state, "s/1")
        rows = df if known is None else ledger.unseen_rows(df, "t", known)
        got = [tuple(r) for r in rows.collect()]
        assert sorted(got, key=repr) == sorted(wave, key=repr)
        ledger.begin_load(spark, state, "s/1", mark)
        assert ledger.load_ledger(spark, state, "s/1") is None  # until the load has ended
        mark = ledger.end_load(spark.createDataFrame(got, SCHEMA), "t", columns, state, "s/1", mark, known)
        assert mark == load_high_water(spark, state, "s/1")
    assert mark == day(8)
    last = ledger.load_ledger(spark, state, "s/1")
    assert set(last.columns) == set(columns) and len(last.parts) <= parts
    assert ledger.load_ledger(spark, state, "other") is None


def test_a_broken_load_is_made_good_from_what_was_written(spark, tmp_path):
    state = str(tmp_path)
    first = spark.createDataFrame([(1, "a", day(1)), (2, "a", None)], SCHEMA)
    ledger.end_load(first, "t", ["id"], state, "s", None, None)
    ledger.begin_load(spark, state, "s", day(1))  # wrote row 3 and died
    written = first.unionByName(spark.createDataFrame([(3, "a", day(1)), (4, "a", day(1))], SCHEMA))
    assert ledger.load_ledger(spark, state, "s") is None and load_high_water(spark, state, "s") == day(1)
    ledger.end_load(written.where("id = 4"), "t", ["id"], state, "s", day(1), None, written)
    again = ledger.unseen_rows(written.unionByName(spark.createDataFrame([(5, "a", day(1))], SCHEMA)), "t", ledger.load_ledger(spark, state, "s"))
    assert [r["id"] for r in again.collect()] == [5]
    assert len(list_folders(spark, f"{state}/_ledger/s")) == 2


def test_marks_of_older_runs_are_taken_over(spark, tmp_path):
    state = str(tmp_path)
    advance_high_water(spark.createDataFrame([(1, "a", day(3))], SCHEMA), "t", state, "s")
    assert load_high_water(spark, state, "s") == day(3) and ledger.load_ledger(spark, state, "s") is None


def test_other_keys_do_not_hold(spark):
    df, known = spark.createDataFrame([], SCHEMA), ledger.Ledger(None, ("id",), ())
    assert ledger.holds_for(known, df, ["id"]) and ledger.holds_for(known, df, None)
    assert not ledger.holds_for(known, df, ["id", "other"]) and not ledger.holds_for(None, df, None)
    assert not ledger.holds_for(ledger.Ledger(None, ("gone",), ()), df, None)


def test_runs_do_not_read_the_tiers(spark, tmp_path, monkeypatch):
    landing, state = str(tmp_path / "in"), str(tmp_path / "state")
    folders = {t: str(tmp_path / t) for t in ("gold", "silver", "bronze", "rejected")}
    source = {"name": "s", "type": "parquet", "path": landing, "incremental": {"column": "t", "keys": ["id"]}}
    looked = []
    monkeypatch.setattr(batch, "loaded_rows", lambda *given: looked.append(given))
    for number, rows in enumerate([[(1, "a", day(1)), (2, "a", None)], [(3, "a", day(1)), (4, "a", None)], [(5, "a", day(2))]]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)
        result = process_all(spark, {"file_sources": [source]}, Run(f"r{number}", dt.datetime(2024, 2, 1), folders, state_path=state)).first()
        assert (result["status"], result["record_count"]) == ("success", len(rows))
    assert len(looked) == 1  # the first load, before there was a ledger
