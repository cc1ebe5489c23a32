"""Arbitrary numpy over tiles (B4/X1): the escape hatch when a tile
function is not expressible with Column expressions.

Tiles travel as Arrow batches (``mapInPandas``); each task reshapes every
array to ``n x n`` and applies the function — no per-row Python calls
through Spark, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def map_tiles(tiles: DataFrame, fn: Callable[[np.ndarray], np.ndarray], n: int, cells: str = "cells",
              out_type: str = "array<bigint>") -> DataFrame:
    keys = [c for c in tiles.columns if c != cells]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [np.asarray(fn(np.asarray(a, dtype="float64").reshape(n, n))).reshape(-1).tolist()
                   for a in pdf[cells]]
            res = pdf[keys].copy()
            res[cells] = out
            yield res

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields if f.name != cells]
                       + [f"`{cells}` {out_type}"])
    return tiles.mapInPandas(run, schema)
