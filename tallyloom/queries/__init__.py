"""Registered queries over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from tallyloom.queries.registry import ORACLES, QUERIES

for _name in ("rollups", "shaping", "selection", "joining", "texts", "records", "loads", "flows", "platforms", "streams"):
    import_module(f"{__name__}.{_name}")

__all__ = ["ORACLES", "QUERIES"]
