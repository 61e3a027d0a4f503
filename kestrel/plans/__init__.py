"""Named plans over the fixture views (one per operator of the inventory)."""

from __future__ import annotations

import importlib

from kestrel.plans.registry import ORACLE, QUERIES

_MODULES = ["weblog", "cleaning", "text", "sentiment", "retrieval", "recsys", "ml", "sources"]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"kestrel.plans.{m}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLE)
