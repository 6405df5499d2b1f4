"""Command line: ``python -m assayer CONFIG [--source NAME] [--streaming [--event-mode]]``.

The configuration is a JSON (or, with PyYAML installed, YAML) file of sources, thresholds and
target paths.
"""

from __future__ import annotations

import argparse
import json
import logging
import uuid
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from assayer.operators.scoring import TIER_THRESHOLDS
from assayer.plans.batch import Run, process_all, process_one
from assayer.plans.live import start_event_streams, start_graded_streams
from assayer.session import build_session
from assayer.sources.config import resolve
from assayer.streaming.runs import TRIGGER, stream_status

log = logging.getLogger("assayer")


def load_config(path: str) -> dict[str, Any]:
    """Read a configuration and fill in its variables."""
    text = Path(path).read_text()
    if path.endswith((".yml", ".yaml")):
        import yaml

        return resolve(yaml.safe_load(text))
    return resolve(json.loads(text))


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assayer", description="Score, grade and store datasets.")
    parser.add_argument("config", help="configuration file")
    parser.add_argument("--source", help="process only this source")
    parser.add_argument("--streaming", action="store_true", help="run the streaming sources instead")
    parser.add_argument("--event-mode", action="store_true", help="with --streaming: log events instead of grading batches")
    parser.add_argument("--trigger-interval", default=TRIGGER)
    parser.add_argument("--window", help="with --streaming: count events in windows of this length instead of grading batches")
    parser.add_argument("--slide", help="distance of the windows' starts, their length unless given")
    parser.add_argument("--verbose", action="store_true")
    return parser.parse_args(arguments)


def run_of(config: dict[str, Any]) -> Run:
    """The settings that all sources share."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return Run(
        run_id=str(uuid.uuid4()),
        run_at=now,
        target_paths=config.get("target_paths", {}),
        thresholds=config.get("default_classification", TIER_THRESHOLDS),
        monitor_path=config.get("monitor_path"),
        documents_path=config.get("documents_path"),
        registry_path=config.get("registry_path"),
        state_path=config.get("state_path"),
        tables=config.get("tier_tables"),
        profile=bool(config.get("profile", False)),
    )


def log_events(events: DataFrame, batch_id: int) -> None:
    log.info("batch %s: %s events", batch_id, events.count())


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    config = load_config(args.config)
    run = run_of(config)
    spark = build_session()
    if not args.streaming:
        results = process_one(spark, config, args.source, run) if args.source else process_all(spark, config, run)
        results.show(truncate=False)
        return
    checkpoint = config["checkpoint_path"]
    if args.event_mode:
        dead = f"{config['stream_path']}/dead_letters" if config.get("stream_path") else None
        queries = start_event_streams(spark, config, log_events, checkpoint, args.trigger_interval, dead_letters=dead)
    else:
        queries = start_graded_streams(spark, config, run, config["stream_path"], checkpoint, args.trigger_interval, args.window, args.slide)
    while any(q.isActive for q in queries.values()):
        spark.streams.awaitAnyTermination(60)
        stream_status(spark, queries.values()).show(truncate=False)


if __name__ == "__main__":
    main()
