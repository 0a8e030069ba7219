"""Stream splitting (O1, P3): one ``route`` column instead of side outputs.

Consumers filter on ``route``; a streaming job that writes every route to
its own sink persists each micro-batch once in ``foreachBatch`` (see
:mod:`eventide.streaming.sinks`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_route(col: str | Column, bands: list[tuple[str, float]], otherwise: str) -> Column:
    """``if col <= b1 -> name1 elif col <= b2 -> name2 ... else otherwise``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, upper in bands:
        expr = (F.when(c <= upper, F.lit(name)) if expr is None
                else expr.when(c <= upper, F.lit(name)))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def route_split(df: DataFrame, col: str, bands: list[tuple[str, float]], otherwise: str,
                name: str = "route") -> DataFrame:
    """O1: tag every row with exactly one route."""
    return df.withColumn(name, band_route(col, bands, otherwise))


def split(df: DataFrame, routes: list[str], name: str = "route") -> dict[str, DataFrame]:
    """The per-route outputs of a routed frame (lazy filters)."""
    return {r: df.filter(F.col(name) == r) for r in routes}
