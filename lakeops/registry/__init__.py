"""Every registered query with its oracle."""

from importlib import import_module

from lakeops.registry.base import ORACLE, QUERIES

MODULES = ("stars", "joining", "timelines", "summarising", "upserts", "streams", "loads", "marts", "people", "branches")

for _module in MODULES:
    import_module(f"lakeops.registry.{_module}")

__all__ = ["ORACLE", "QUERIES"]
