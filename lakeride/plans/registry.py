"""Collects the named queries and their SQL oracles from the catalogue modules."""

from __future__ import annotations

import importlib

# catalogue modules register themselves on import
_MODULES = ("catalog", "catalog_metrics", "catalog_tables", "oracle", "oracle_metrics")


def _load():
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")
    from .catalog import CATALOG
    from .oracle import ORACLE
    return CATALOG, ORACLE


def all_queries():
    catalog, _ = _load()
    return dict(catalog)


def all_oracle_sql():
    catalog, oracle = _load()
    return {k: v for k, v in oracle.items() if k in catalog}
