"""All registered queries: name -> (Spark callable, DuckDB text or None)."""

from __future__ import annotations

import importlib

MODULES = ["flows", "mappings", "checks", "history", "loads", "expressions", "streams"]


def all_queries() -> dict:
    found: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"queries.{name}")
        for key, pair in module.QUERIES.items():
            if key in found:
                raise ValueError(f"query {key} is registered twice")
            found[key] = pair
    return found
