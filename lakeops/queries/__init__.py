"""All registered queries."""

from __future__ import annotations

import importlib
import pkgutil

from lakeops.queries.registry import ORACLES, QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]
