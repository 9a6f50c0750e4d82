"""Registered queries over the star-schema test tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

from placeweave.queries.registry import QUERIES, SQL

for _module in ("scans", "columns", "keyed", "summaries", "flows", "shapes", "regions"):
    import_module(f"placeweave.queries.{_module}")

__all__ = ["QUERIES", "SQL"]
