"""Registered queries over the stored tables (with DuckDB oracles)."""

from . import joined, patterns, windowed  # noqa: F401  (registers queries)
from . import connectors, streams  # noqa: F401,E402  (these reuse the batch oracles)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
