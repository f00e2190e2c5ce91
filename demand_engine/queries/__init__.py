"""Registered queries: each runs an operator over the given tables, most with an SQL counterpart."""

from __future__ import annotations

from importlib import import_module

from demand_engine.queries.registry import ORACLES, QUERIES

for _area in ("demand", "stations", "report", "ingest", "weather", "model"):
    import_module(f"demand_engine.queries.{_area}")

__all__ = ["ORACLES", "QUERIES"]
