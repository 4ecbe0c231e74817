"""All registered queries and their DuckDB oracles, merged from the groups."""

from __future__ import annotations

import importlib

_GROUPS = ["clean", "analytics", "windows", "models", "trees", "serving", "streams"]


def _load(kind: str) -> dict:
    out: dict = {}
    for g in _GROUPS:
        try:
            mod = importlib.import_module(f"tripcast.plans.{kind}_{g}")
        except ModuleNotFoundError as exc:
            if exc.name != f"tripcast.plans.{kind}_{g}":
                raise
            continue
        table = getattr(mod, kind.upper())
        dup = set(out) & set(table)
        if dup:
            raise ValueError(f"duplicate query names: {sorted(dup)}")
        out.update(table)
    return out


def all_queries() -> dict:
    return _load("queries")


def all_oracles() -> dict:
    return _load("oracles")
