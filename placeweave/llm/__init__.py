"""Operators for training-data pipelines, with their queries. Nothing else in the library imports this."""

from __future__ import annotations

import sys
from importlib import import_module

from pyspark import cloudpickle

from placeweave.llm.shared import QUERIES, SQL

# Functions that run in tasks travel whole, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

for _module in ("alignment", "exact", "languages", "lines", "main_text", "mixing", "near", "passages", "quality", "repeats", "runs", "templates", "urls"):
    import_module(f"placeweave.llm.{_module}")

__all__ = ["QUERIES", "SQL"]
