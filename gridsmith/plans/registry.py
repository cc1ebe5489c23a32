"""Registry of named queries (``queries()``) and their DuckDB oracles.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables; the
oracle is an independent SQL statement over the same tables.  Registered
outputs round computed doubles to 6 places on both sides so that summation
order (partitioned vs. single-threaded) cannot flip the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def r6(c, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col, 6)
    return out.alias(name or (c if isinstance(c, str) else "v"))


def load_all() -> None:
    # Importing the plan modules fills the registry.
    from gridsmith.plans import crops, imagery, mosaics, grid, catalog_plans, ingest_plans, focal_plans, render_plans  # noqa: F401
    from gridsmith.plans import raster_plans, tile_plans  # noqa: F401  (reuse oracles registered above)
