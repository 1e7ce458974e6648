"""All registered queries and their DuckDB oracle SQL, keyed by inventory ID."""

from __future__ import annotations

import importlib

PLAN_MODULES = ["analytics", "etl", "splitting", "modelling", "learning", "clusters", "forest", "extras"]


def _modules():
    return [importlib.import_module(f"rankwell.plans.{m}") for m in PLAN_MODULES]


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _modules():
        out.update(getattr(m, "ORACLE", {}))
    return out
