"""Named queries over the check tables, one or more per operator, with their SQL twins."""

from __future__ import annotations

import importlib
import pkgutil

from seriesloom.catalog.base import ORACLES, QUERIES

for _m in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_m.name}")

__all__ = ["ORACLES", "QUERIES"]
