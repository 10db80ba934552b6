"""Queries over the driver's tables, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scans", "predicates", "joins", "aggregates", "ordering", "texts", "vectors", "graphs", "bayes", "mining", "curation", "units")


def collected() -> tuple[dict, dict]:
    from .registry import ORACLES, QUERIES

    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return dict(QUERIES), dict(ORACLES)
