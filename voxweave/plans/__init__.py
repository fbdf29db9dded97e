"""Registered queries. Each module wires library functions to the given tables."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES

MODULES = ("corpus", "tokens", "request_tables", "vector_queries", "clip_queries", "storage_queries")


def _load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
