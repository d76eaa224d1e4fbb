"""Registered queries over the driver tables, each next to the SQL that must give the same rows."""

from exprspark.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
