"""Imports every module that registers queries."""

from tidemark.plans import joins, marts, streams, warehouse, windows  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
