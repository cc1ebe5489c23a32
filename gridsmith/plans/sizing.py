"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if its *bound* (not an estimate) is below this.
BROADCAST_ROW_BOUND = 2_000_000


def broadcast_if_bounded(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Broadcast ``df`` when ``row_bound`` proves it small; else leave the
    choice to Catalyst/AQE (shuffle join, or runtime broadcast when the
    measured shuffle output turns out small)."""
    if row_bound is not None and row_bound <= BROADCAST_ROW_BOUND:
        return F.broadcast(df)
    return df


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast a lookup only after checking its size: counting at most
    ``max_rows + 1`` rows proves the bound cheaply even for a huge input;
    beyond it the join stays a shuffle join (or AQE's runtime choice)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
