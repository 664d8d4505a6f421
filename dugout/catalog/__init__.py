"""Registered queries: the library's operators and models over the driver's tables."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

for _part in ("model_queries", "dimension_queries", "operator_queries", "calendar_queries", "quality_queries", "serving_queries", "landing_queries", "audit_queries", "star_queries", "expectation_queries"):
    importlib.import_module(f"{__name__}.{_part}")

__all__ = ["QUERIES", "ORACLES"]
