"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: str = ""):
    """Register ``fn(spark, sf_dir)``. ``needs`` names the CTEs of the SQL."""
    from catalog.ctes import with_ctes

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(needs.split(), sql)
        return fn

    return wrap


def load() -> None:
    from catalog import (  # noqa: F401
        aggregates, fields, filters, joins, ordering, scalars, scans, sets, tables, units,
    )
