"""Look-ups in JSON payloads that arrive as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path(path: str) -> str:
    """A dotted path as a JSON path: ``data.items`` becomes ``$.data.items``."""
    return "$" + "".join(f"['{part}']" for part in path.split(".") if part)


def lookup(payload: Column, path: str) -> Column:
    """Text found at a dotted path, null where a key is missing or the payload is no JSON."""
    return F.get_json_object(payload, json_path(path)) if path else payload


def lookup_array(payload: Column, path: str, element: str, single: bool = False) -> Column:
    """The array at a dotted path with elements of type ``element``; null where it is no array.

    With ``single`` an object counts as an array of one element, as the JSON reader takes it.
    """
    found = F.trim(lookup(payload, path))
    readable = F.startswith(found, F.lit("["))
    if single:
        readable = readable | F.startswith(found, F.lit("{"))
    return F.when(readable, F.from_json(found, f"array<{element}>"))


def read_paths(payload: Column, leaves: Mapping[str, str]) -> dict[str, Column]:
    """What lies at several dotted paths, each as its own type, from one reading of the payload.

    A leaf of type ``string`` holds the JSON text of whatever is found there.
    """
    tree: dict = {}
    for path, kind in leaves.items():
        *parents, leaf = path.split(".")
        node = tree
        for part in parents:
            node = node.setdefault(part, {})
        node[leaf] = kind

    def ddl(node: Mapping | str) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"`{name}`:{ddl(child)}" for name, child in node.items()) + ">"

    read = F.from_json(payload, ddl(tree))
    found = {}
    for path in leaves:
        value = read
        for part in path.split("."):
            value = value.getField(part)
        found[path] = value
    return found


def is_json_null(payload: Column, path: str) -> Column:
    """Whether a JSON null stands at a dotted path; a missing key is none."""
    found = F.try_variant_get(F.try_parse_json(payload), json_path(path), "variant")
    return F.coalesce(F.is_variant_null(found), F.lit(False))


def is_truthy(found: Column) -> Column:
    """Whether a JSON value counts as yes: not missing, false, zero, empty text, list or object."""
    return F.coalesce(~found.isin("false", "0", "0.0", "", "null", "[]", "{}"), F.lit(False))
