"""Query registry. Importing the catalog modules fills it."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODULES = ("counts", "tables", "enrichment", "cells", "coverage", "files")

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}
_ctes: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    """Name a piece of SQL; any oracle that mentions the name gets it in its WITH list."""
    _ctes[name] = sql.strip()


def with_ctes(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\bc_\w+", text)):
            if word in _ctes and word not in needed:
                visit(_ctes[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    body = sql.strip()
    if not needed:
        return body
    head = ", ".join(f"{n} AS ({_ctes[n]})" for n in needed)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"


def query(name: str, sql: str | None = None):
    def register(fn):
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def r(col: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"exprspark.catalog.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return {name: with_ctes(sql) for name, sql in _oracles.items()}
