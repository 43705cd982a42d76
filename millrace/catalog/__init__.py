"""Registered queries: each names a Spark callable and, where SQL can say it, an oracle.

``load()`` imports the query modules, which fill ``REGISTRY``.
"""

from __future__ import annotations

import importlib

from millrace.catalog.registry import REGISTRY

_MODULES = ["scans", "sinks", "snapshots", "long_series", "projections", "joins", "aggregates", "windows", "tops", "scalars", "streams", "models", "alerts"]


def load():
    for name in _MODULES:
        importlib.import_module(f"millrace.catalog.{name}")
    return REGISTRY
