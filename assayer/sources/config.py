"""Source settings: one key set, both spellings accepted, variables filled in."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from typing import Any

# Source families in the order they are processed.
FAMILIES = ("file", "database", "api", "kafka", "nvd")

# Older spellings of a key and the one used here.
KEY_ALIASES = {
    "file": {"type": "format"},
    "database": {"jdbc_options": "options", "connection_string": "url"},
    "api": {"response_path": "results_path"},
    "kafka": {"kafka_options": "options", "auto_offset_reset": "starting_offsets"},
    "nvd": {},
}
SECRET = re.compile(r"password|secret|token|api_?key|authorization|credential", re.IGNORECASE)
VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::([^}]*))?\}")


def resolve(value: Any, variables: Mapping[str, str] | None = None) -> Any:
    """Fill in ``${NAME}`` and ``${NAME:default}`` anywhere in a nested setting.

    An unset variable without a default becomes empty when it is the whole value, and stays as
    written inside a longer text.
    """
    env = os.environ if variables is None else variables
    if isinstance(value, Mapping):
        return {k: resolve(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [resolve(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def fill(match: re.Match) -> str:
        unset = "" if match[0] == value else match[0]
        return env.get(match[1], unset if match[2] is None else match[2])

    return VARIABLE.sub(fill, value)


def normalise(source: Mapping[str, Any], family: str) -> dict[str, Any]:
    """One spelling per key; the newer one wins where both are given."""
    if family not in FAMILIES:
        raise ValueError(f"unknown source family {family!r}")
    aliases = KEY_ALIASES[family]
    settings = {aliases.get(k, k): v for k, v in source.items() if k in aliases}
    settings.update({k: v for k, v in source.items() if k not in aliases})
    if family == "api" and "url" not in settings and "base_url" in settings:
        settings["url"] = settings["base_url"].rstrip("/") + "/" + settings.get("endpoint", "").lstrip("/")
    return settings


def all_sources(config: Mapping[str, Any]) -> Iterator[tuple[str, dict[str, Any]]]:
    """(family, settings) of every enabled source, in processing order."""
    for family in FAMILIES:
        for source in config.get(f"{family}_sources") or ():
            if source.get("enabled", True):
                yield family, normalise(resolve(source), family)


def find_source(config: Mapping[str, Any], name: str) -> tuple[str, dict[str, Any]]:
    """(family, settings) of one source by name."""
    for family in FAMILIES:
        for source in config.get(f"{family}_sources") or ():
            if source.get("name") == name:
                return family, normalise(resolve(source), family)
    raise ValueError(f"no source named {name!r}")


def streaming_sources(config: Mapping[str, Any]) -> list[dict[str, Any]]:
    """Message sources that are enabled and marked for streaming (off unless said otherwise)."""
    return [s for family, s in all_sources(config) if family == "kafka" and s.get("streaming_enabled", False)]


def without_secrets(settings: Mapping[str, Any]) -> dict[str, Any]:
    """Settings fit to be stored in a catalog table."""
    return {
        k: without_secrets(v) if isinstance(v, Mapping) else v for k, v in settings.items() if not SECRET.search(k)
    }
