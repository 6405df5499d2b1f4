"""Claims on schema versions, cells rescued from a cast, schema changes that land late, sources within a time limit."""

import datetime as dt
import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from assayer.operators import registry, runlog
from assayer.operators.schema import Field, SchemaDefinition, apply_evolution, rescue_counts
from assayer.plans import batch
from assayer.plans.batch import Run, grade_source, process_all
from assayer.session import list_folders
from assayer.streaming import runs, schema_changes

RUN_AT = dt.datetime(2024, 2, 1)


def defined(version, *names, schema="s"):
    return SchemaDefinition(schema, version, tuple(Field(n, "int") for n in names))


def test_one_of_two_writers_gets_a_version(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.add_version(spark, path, defined(1, "a"))
    start = threading.Barrier(4)

    def write(name):
        start.wait()
        try:
            return registry.evolve(spark, path, "s", {"add_fields": [Field(name, "string")]}, 2).by_name.keys()
        except registry.VersionTaken as told:
            return str(told)

    with ThreadPoolExecutor(4) as pool:
        said = list(pool.map(write, ["b", "c", "d", "e"]))
    won = [s for s in said if not isinstance(s, str)]
    assert len(won) == 1 and registry.get_version(spark, path, "s", 2).by_name.keys() == won[0]
    assert spark.read.parquet(path).where("version = 2").count() == 1


def test_a_definition_may_claim_again(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.claim_version(spark, path, defined(2, "a"))  # and its writer died
    with pytest.raises(registry.VersionTaken):
        registry.add_version(spark, path, defined(2, "b"))
    for _ in range(2):
        registry.add_version(spark, path, defined(2, "a"))
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="is registered"):
        registry.release_version(spark, path, "s", 2)
    registry.claim_version(spark, path, defined(3, "a"))
    assert registry.release_version(spark, path, "s", 3) and not registry.release_version(spark, path, "s", 3)
    registry.add_version(spark, path, defined(3, "z"))
    registry.register_version(spark, path, defined(7, "old"))  # from before there were claims
    with pytest.raises(registry.VersionTaken):
        registry.add_version(spark, path, defined(7, "new"))


def test_unversioned_and_first_do_not_merge(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.add_version(spark, path, defined(0, "a"))
    with pytest.raises(registry.VersionTaken):
        registry.add_version(spark, path, defined(1, "b"))
    registry.add_version(spark, path, defined(1, "a"))
    registry.add_version(spark, path, defined(1, "b", schema="t/2"))
    assert registry.get_version(spark, path, "s", 1).by_name.keys() == {"a"}
    assert spark.read.parquet(path).count() == 2


def test_cells_that_do_not_fit_are_kept(spark):
    old = SchemaDefinition("s", 1, (Field("k", "int"), Field("n", "string"), Field("was", "string"), Field("ok", "string")))
    new = SchemaDefinition("s", 2, (Field("k", "int"), Field("n", "int"), Field("is", "timestamp", previous_name="was"), Field("ok", "string")))
    rows = [(1, "7", "2024-01-01", "x"), (2, "seven", "soon", "x"), (3, None, "", None), (4, "", None, "")]
    df = spark.createDataFrame(rows, "k int, n string, was string, ok string")
    evolved = apply_evolution(df, old, new, "lost")
    assert {r["k"]: r["lost"] for r in evolved.collect()} == {1: None, 2: {"n": "seven", "is": "soon"}, 3: {"is": ""}, 4: {"n": ""}}
    counts = rescue_counts(evolved, "lost")
    assert evolved.agg(*(c.alias(n) for n, c in counts.items())).first().asDict() == {"n": 2, "is": 2}
    assert apply_evolution(df, old, new).columns == ["k", "n", "is", "ok"]
    assert "lost" not in apply_evolution(df, old, old, "lost").columns and rescue_counts(df, "lost") == {}
    with pytest.raises(ValueError, match="already"):
        apply_evolution(df, old, new, "ok")
    nested = spark.createDataFrame([(1, ["a"])], "k int, n array<string>")
    flat = SchemaDefinition("s", 2, (Field("k", "int"), Field("n", "int")))
    try:
        assert apply_evolution(nested, defined(1, "k", "n"), flat, "lost").first()["lost"] == {"n": '["a"]'}
    except Exception as refused:  # such a cast has no meaning at all, and the plan says so
        assert "CAST" in str(refused)


def test_rescued_cells_are_no_part_of_the_grade(spark, tmp_path):
    old, new = SchemaDefinition("s", 1, (Field("k", "int"), Field("n", "string"))), SchemaDefinition("s", 2, (Field("k", "int"), Field("n", "int")))
    df = spark.createDataFrame([(i, "x" if i % 4 == 0 else str(i)) for i in range(8)], "k int, n string")
    source = {"name": "s", "schema_version": 1, "target_schema_version": 2}
    run = Run("r", RUN_AT, {t: str(tmp_path / t) for t in ("gold", "silver", "bronze", "rejected")}, schemas={("s", 1): old, ("s", 2): new}, monitor_path=str(tmp_path / "m"), profile=True)
    graded, row = grade_source(df, source, run)
    assert (row["completeness"], row["schema_valid"], row["schema_warning_count"]) == (14 / 16, True, 1)
    assert [(i["column_name"], i["issue_type"], i["severity"], i["description"].split()[0]) for i in row["issues"]] == [("n", "cast", "warning", "2")]
    assert {r["_rescued"]["n"] for r in graded.where("_rescued is not null").collect()} == {"x"}
    df.write.parquet(str(tmp_path / "in"))
    config = {"file_sources": [{**source, "type": "parquet", "path": str(tmp_path / "in")}]}
    published = Run("p", RUN_AT, schemas=run.schemas, store_path=str(tmp_path / "store"), monitor_path=str(tmp_path / "m2"), profile=True)
    for each in (run, published):
        result = process_all(spark, config, each).first()
        assert (result["status"], result["completeness"], result["report_error"]) == ("success", 14 / 16, None)
        assert spark.read.parquet(f"{each.monitor_path}/issues").where("issue_type = 'cast'").count() == 1


def versions(n):
    fields = lambda k: ", ".join('{"name": "f%d", "type": "int", "nullable": true}' % i for i in range(k % 3, k))
    return [(s, k, '{"name": "%s", "version": %d, "fields": [%s]}' % (s, k, fields(k))) for s in ("s", "t") for k in range(1, n)]


@pytest.mark.parametrize("wave", [lambda s, k: k % 2, lambda s, k: -k, lambda s, k: k // 3])
def test_schema_changes_in_any_order(spark, tmp_path, wave):
    landed = versions(8)
    known, events = str(tmp_path / "known"), str(tmp_path / "events")
    record = schema_changes.record_schema_changes(known, events, buckets=3)
    waves = sorted({wave(s, k) for s, k, _ in landed})
    for number, which in enumerate(waves):
        part = spark.createDataFrame([v for v in landed if wave(v[0], v[1]) == which], "schema_name string, version int, definition string")
        record(part, number)
        if number == len(waves) - 2:
            record(part, number)  # a batch that is run again
        for bucket in range(3):
            kept = schema_changes.generations(spark, f"{known}/_latest", bucket)
            assert len(kept) <= 2
    found = sorted(tuple(r) for r in schema_changes.changed_fields(spark.read.parquet(events)).collect())
    expected = []
    for s in ("s", "t"):
        for k in range(1, 8):
            before, after = set(range((k - 1) % 3, k - 1)), set(range(k % 3, k))
            expected += [(s, k, f"f{i}", "add") for i in after - before] + [(s, k, f"f{i}", "remove") for i in before - after]
    assert found == sorted(expected)
    assert spark.read.parquet(known).count() == 14
    numbers = spark.read.schema(f"{schema_changes.LATEST}, bucket int, batch bigint").parquet(f"{known}/_latest")
    assert {(r["schema_name"], r["v"]) for r in numbers.groupBy("schema_name").agg(F.max("version").alias("v")).collect()} == {("s", 7), ("t", 7)}


def test_a_registry_without_kept_state_is_taken_over(spark, tmp_path):
    known, events = str(tmp_path / "known"), str(tmp_path / "events")
    frame = lambda rows: spark.createDataFrame(rows, "schema_name string, version int, definition string")
    frame(versions(4)).write.parquet(f"{known}/batch_id=0")
    schema_changes.record_schema_changes(known, events)(frame([v for v in versions(5) if v[:2] == ("t", 4)]), 1)
    schema_changes.record_schema_changes(known, events)(frame([v for v in versions(5) if v[:2] == ("s", 4)]), 2)
    assert {(r["schema_name"], json.loads(r["old_definition"])["version"]) for r in spark.read.parquet(events).collect()} == {("s", 3), ("t", 3)}
    assert list_folders(spark, f"{known}/_latest")


def test_a_slow_source_is_cancelled_and_delays_nobody(spark, tmp_path, monkeypatch):
    slow = F.udf(lambda i: time.sleep(0.4) or i, "bigint")
    spark.range(20).write.parquet(str(tmp_path / "in"))
    read = batch.read_source

    def slowly(spark, family, source):
        df = read(spark, family, source)
        return spark.range(0, 800, 1, 800).select(slow("id").alias("id")) if source["name"] == "slow" else df

    monkeypatch.setattr(batch, "read_source", slowly)
    ended, treat = {}, batch.treat_source

    def timed(spark, family, source, run, seq=0):
        result = treat(spark, family, source, run, seq)
        ended[source["name"]] = time.time()
        return result

    monkeypatch.setattr(batch, "treat_source", timed)
    names = ["slow", "a", "b", "c"]
    sources = [{"name": n, "type": "parquet", "path": str(tmp_path / "in"), **({"time_limit_seconds": 12} if n == "slow" else {"time_limit_seconds": 600})} for n in names]
    run = Run("r", RUN_AT, {t: str(tmp_path / t) for t in ("gold", "silver", "bronze", "rejected")}, monitor_path=str(tmp_path / "m"))
    results = {r["source_name"]: r for r in process_all(spark, {"file_sources": sources}, run, at_once=2).collect()}
    assert {n: r["status"] for n, r in results.items()} == {"slow": "failed", "a": "success", "b": "success", "c": "success"}
    assert "time limit of 12 s" in results["slow"]["message"]
    assert max(ended[n] for n in ("a", "b", "c")) < ended["slow"]
    assert spark.range(3).count() == 3  # later jobs of the thread are not cancelled
    logged = runlog.parse_lines(runlog.read_run_log(spark, f"{tmp_path}/m/run_log"))
    assert logged.where("kind = 'source'").count() == 4
    assert runlog.run_rows(logged).first()["sources_failed"] == 1
