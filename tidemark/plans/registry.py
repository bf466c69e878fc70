"""Where queries and their oracle SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name, with the SQL that must give the same rows."""
    def register(run: Run) -> Run:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run
    return register
