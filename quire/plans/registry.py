"""Registered queries and their SQL twins, gathered from the modules of this package."""

from __future__ import annotations

from . import archive_queries, catalog_queries, item_queries, shape_queries, sheet_queries, source_queries, store_queries, text_queries

_MODULES = (text_queries, sheet_queries, item_queries, archive_queries, catalog_queries, source_queries, shape_queries, store_queries)

QUERIES: dict = {}
ORACLES: dict = {}
for _m in _MODULES:
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
