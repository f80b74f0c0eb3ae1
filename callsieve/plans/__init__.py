"""Named queries over the given tables."""

import importlib

from .registry import ORACLES, QUERIES

for _area in ("risk", "complaints", "behavior", "cleaning", "profiling", "evaluation", "drift", "experiments", "reputation", "live", "datasets", "injection", "clusters", "models", "files", "streams"):
    importlib.import_module(f"{__name__}.{_area}")

__all__ = ["ORACLES", "QUERIES"]
