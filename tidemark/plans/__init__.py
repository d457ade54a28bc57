"""Layer tables and registered queries."""

from __future__ import annotations

import importlib

from tidemark.plans.registry import ORACLE, QUERIES, Job

_MODULES = ("layers", "profile", "ranking", "forecast", "risk")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"tidemark.plans.queries_{name}")


def all_queries() -> dict[str, Job]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLE)
