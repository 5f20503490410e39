"""Registered queries: every module adds its Spark callables and their SQL twins."""

from __future__ import annotations

from importlib import import_module

from millrace.queries.registry import ORACLES, QUERIES

_GROUPS = (
    "scans", "sinks", "projections", "filters", "joins", "aggregates",
    "charts", "sorting", "scalar", "streams", "versions", "features",
    "learning", "user_functions", "flagship",
)

for _group in _GROUPS:
    import_module(f"millrace.queries.{_group}")

__all__ = ["ORACLES", "QUERIES"]
