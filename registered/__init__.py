"""Registered queries over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

_MODULES = ["first", "second", "third"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        part = getattr(importlib.import_module(f"registered.{name}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_sql() -> dict:
    return _merged("SQL")
