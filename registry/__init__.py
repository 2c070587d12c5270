"""Queries over the given tables, one or more per operator, with their SQL."""

import importlib

from registry.base import QUERIES, Query

for _m in ("scalars", "records", "matching", "reports", "sections", "pages", "state"):
    try:
        importlib.import_module(f"registry.{_m}")
    except ModuleNotFoundError as e:
        if e.name != f"registry.{_m}":
            raise

__all__ = ["QUERIES", "Query"]
