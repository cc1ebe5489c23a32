"""Pyramids of multiband, space-time tile layers, written level by level into a catalog.

A level's cell is the mean of all present cells of the base layer below it: tiles carry a sum and a count per band, so a
parent with one present child of four weighs that child alone, at every level.  A pass makes several levels with one
shuffle: each tile adds its block sums to its ancestors of the next levels (a tile of n cells a side gives n/2^k a side k
levels up), and the rows of an ancestor meet one by one in a sorted partition.  An ancestor takes 4^levels rows at most,
n x n cells in all, so a pass ships a third of its input's cells and a top tile never sees the base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsmith.operators.rasters import Grid, list_column, rows_of
from gridsmith.session import cut_lineage

LEVELS = 4


def block_sums(a: np.ndarray, side: int) -> np.ndarray:
    """Sums of side x side blocks of the last two axes."""
    m = a.shape[-1] // side
    return a.reshape(*a.shape[:-2], m, side, m, side).sum(axis=(-3, -1))


def sums_of(tiles: DataFrame, bands: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Tiles with ``<band>_sum`` and ``<band>_count`` arrays instead of the bands."""
    both = [x for b in bands for x in (
        F.transform(b, lambda v: F.coalesce(v.cast("double"), F.lit(0.0))).alias(f"{b}_sum"),
        F.transform(b, lambda v: F.when(v.isNotNull(), 1.0).otherwise(0.0)).alias(f"{b}_count"))]
    return tiles.select(*extra, F.col("col").cast("long"), F.col("row").cast("long"), *both)


def next_levels(sums: DataFrame, n: int, zoom: int, levels: int, bands: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """``(extra..., zoom, col, row, sums and counts)`` of the ``levels`` levels above tiles of sums at ``zoom``."""
    if n & (n - 1):
        raise ValueError("pyramids need tiles of a power of two cells a side")
    arrays = [f"{b}_{x}" for b in bands for x in ("sum", "count")]
    kept = [sums.schema[x] for x in extra]
    keys = [*kept, T.StructField("zoom", T.IntegerType()), T.StructField("col", T.LongType()), T.StructField("row", T.LongType())]
    names, lists = [k.name for k in keys], [T.StructField(x, T.ArrayType(T.DoubleType())) for x in arrays]
    place = [T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType()), T.StructField("side", T.IntegerType())]

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tiles = np.stack([np.stack(rows_of(b.column(x))) for x in arrays], axis=1).reshape(b.num_rows, len(arrays), n, n)
            col, row = (b.column(c).to_numpy() for c in ("col", "row"))
            for k in range(1, levels + 1):
                side = max(1, n >> k)
                part = block_sums(tiles, n // side).reshape(b.num_rows, len(arrays), -1)
                # first cell of the tile, k levels up, in its ancestor
                x, y = ((c * n >> k) - (c >> k) * n for c in (col, row))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in extra], pa.array(np.full(b.num_rows, zoom - k), pa.int32()), pa.array(col >> k), pa.array(row >> k),
                     *[pa.array(v.astype(np.int32)) for v in (x, y, np.full(b.num_rows, side))],
                     *[list_column(list(part[:, i])) for i in range(len(arrays))]],
                    [*names, "x", "y", "side", *arrays])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, total = None, None, None

        def done() -> pa.RecordBatch:
            columns = [head.column(c) for c in names] + [list_column([total[i].ravel()]) for i in range(len(arrays))]
            return pa.RecordBatch.from_arrays(columns, [*names, *arrays])

        for b in batches:
            values = [rows_of(b.column(x)) for x in arrays]
            at = zip(*(b.column(c).to_pylist() for c in ("x", "y", "side")))
            for i, (one, (x, y, side)) in enumerate(zip(zip(*(b.column(c).to_pylist() for c in names)), at)):
                if one != key:
                    if key is not None:
                        yield done()
                    key, head, total = one, b.slice(i, 1), np.zeros((len(arrays), n, n))
                total[:, y:y + side, x:x + side] += np.stack([v[i] for v in values]).reshape(-1, side, side)
        if key is not None:
            yield done()

    sent = sums.select(*extra, "col", "row", *arrays).mapInArrow(up, T.StructType([*keys, *place, *lists]))
    return sent.repartition(*names).sortWithinPartitions(*names, "x", "y").mapInArrow(add, T.StructType([*keys, *lists]))


def means(levels: DataFrame, bands: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Band arrays of tiles of sums; a cell without present cells below it is missing."""
    mean = lambda b: F.zip_with(f"{b}_sum", f"{b}_count", lambda s, c: F.when(c > 0, s / c))
    return levels.select(*extra, "zoom", "col", "row", *[mean(b).alias(b) for b in bands])


def band_pyramid(tiles: DataFrame, n: int, zoom: int, bands: list[str], to: int = 0, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(extra..., zoom, col, row, bands...)`` of all levels below ``zoom`` down to ``to`` (W3).  Each pass of up to four
    levels is checkpointed to the shared folder: the next one reads its top level."""
    sums, out = sums_of(tiles, bands, extra), None
    while zoom > to:
        k = min(LEVELS, zoom - to)
        made = cut_lineage(next_levels(sums, n, zoom, k, bands, extra))
        zoom -= k
        sums = made.where(F.col("zoom") == zoom).drop("zoom")
        made = means(made, bands, extra)
        out = made if out is None else out.unionByName(made)
    return out


def write_pyramid(tiles: DataFrame, root: str, layer: str, n: int, zoom: int, bands: list[str], to: int = 0,
                  cell_type: str = "float64", nodata=None, grid: Grid | None = None) -> None:
    """Write the base layer and all its levels down to ``to`` into a catalog (A12), each with its metadata row, by upsert:
    levels that exist take the new tiles, and a rerun changes nothing.  Tiles may have an ``instant``.  ``grid`` places the
    base level; a level's cells are twice as large as those of the level below it."""
    from gridsmith.sources.catalog import upsert_layer
    extra = tuple(c for c in ("instant",) if c in tiles.columns)
    base = tiles.select(*extra, "col", "row", *[F.col(b).cast("array<double>").alias(b) for b in bands])
    levels = band_pyramid(base, n, zoom, bands, to, extra)
    for z in range(zoom, to - 1, -1):
        rows = base if z == zoom else levels.where(F.col("zoom") == z).drop("zoom")
        at = None if grid is None else Grid(grid.x0, grid.y0, grid.cell * 2 ** (zoom - z), n, grid.crs)
        upsert_layer(rows, root, layer, z, n, [*extra, "col", "row"], cell_type, nodata, at)
