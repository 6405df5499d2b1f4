"""Whole plans: source runs, and the registered queries with their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

QUERY_MODULES = ("scores", "schemas", "ingest", "monitoring", "storage", "streams")


def load_queries():
    """(queries, SQL) of all query modules, by name."""
    for module in QUERY_MODULES:
        import_module(f"assayer.plans.{module}")
    from assayer.plans.catalog import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
