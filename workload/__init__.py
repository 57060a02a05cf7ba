"""Queries over the given tables that exercise every operator, with their SQL."""

from __future__ import annotations

import importlib

MODULES = ("q_values", "q_rows", "q_documents", "q_changes", "q_vault", "q_catalog", "q_files")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")


def all_queries():
    from .registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from .registry import ORACLES

    _load()
    return dict(ORACLES)
