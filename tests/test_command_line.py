from __future__ import annotations

import json

from assayer import __main__ as command


def test_configuration_files(tmp_path, monkeypatch):
    monkeypatch.setenv("DATA", "/d")
    settings = {"target_paths": {"gold": "${DATA}/gold", "silver": "${ELSE:/e}/silver"}, "monitor_path": "/m"}
    for name in ("c.json", "c.yml"):  # JSON is YAML too
        path = tmp_path / name
        path.write_text(json.dumps(settings))
        if name.endswith("yml"):
            import pytest

            pytest.importorskip("yaml")
        run = command.run_of(command.load_config(str(path)))
        assert run.target_paths == {"gold": "/d/gold", "silver": "/e/silver"}
        assert (run.monitor_path, run.registry_path) == ("/m", None)


def test_arguments():
    args = command.parse(["c.json", "--source", "s", "--verbose"])
    assert (args.config, args.source, args.streaming, args.trigger_interval) == ("c.json", "s", False, "10 seconds")
    windows = command.parse(["c.json", "--streaming", "--window", "1 hour", "--slide", "5 minutes"])
    assert (windows.window, windows.slide) == ("1 hour", "5 minutes")


def test_a_batch_run(spark, sf_dir, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda: spark)
    tiers = {t: str(tmp_path / t) for t in ("gold", "silver", "bronze", "rejected")}
    source = {"name": "customers", "type": "parquet", "path": f"{sf_dir}/customer.parquet"}
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"file_sources": [source], "target_paths": tiers, "registry_path": str(tmp_path / "registry")}))
    command.main([str(path)])
    command.main([str(path), "--source", "customers"])
    assert "customers" in capsys.readouterr().out
    written = spark.read.parquet(str(tmp_path / "bronze" / "customers"))
    assert [r["count"] for r in written.groupBy("ingestion_run").count().collect()] == [150, 150]  # each run keeps its own
