"""Registered queries: each operator over the given tables, next to an equivalent SQL statement."""

from __future__ import annotations

import importlib

from adloom.plans.registered.base import REGISTRY, Query

MODULES = [
    "statistics", "incremental", "enrichment", "gates", "text", "matching", "specs", "payloads",
    "pages", "catalog", "sinks", "streams", "ingest", "roundtrips",
]


def load_all() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return dict(REGISTRY)
