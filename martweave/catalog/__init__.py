"""All registered queries and their check SQL."""

from __future__ import annotations

from importlib import import_module

PARTS = ["marketplace", "customers", "hotel", "spend", "shop", "bank", "university", "quality", "declared", "stored", "model", "signals", "streams"]


def _catalogs():
    return [import_module(f"{__name__}.{part}").catalog for part in PARTS]


def all_queries() -> dict:
    merged: dict = {}
    for catalog in _catalogs():
        overlap = merged.keys() & catalog.queries.keys()
        if overlap:
            raise ValueError(f"queries registered twice: {sorted(overlap)}")
        merged.update(catalog.queries)
    return merged


def all_checks() -> dict[str, str]:
    return {name: sql for catalog in _catalogs() for name, sql in catalog.checks.items()}
