"""Cell grain <-> tile grain, and layout keying.

A tile row holds a dense row-major array of ``n*n`` cells (NULL = NoData).
Going to tiles is a ``groupBy(tile key)`` whose group size is bounded by the
layout (at most ``n*n`` distinct cells, after de-duplicating each cell).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.functions.grid import tile_of


def tiles_to_cells(tiles: DataFrame, n: int, cells: str = "cells", value: str = "value",
                   keys=("col", "row"), extra=()) -> DataFrame:
    """Explode each tile into ``(gx, gy, value)``; NoData (NULL) cells stay out."""
    t = tiles.select(*keys, *extra, F.posexplode(cells).alias("pos", value))
    return (t.where(F.col(value).isNotNull())
            .select(*extra, (F.col(keys[0]) * n + F.col("pos") % n).alias("gx"),
                    (F.col(keys[1]) * n + F.floor(F.col("pos") / n)).alias("gy"), value))


def cells_to_tiles(cells: DataFrame, n: int, value: str = "value", extra=(), merge: str = "max") -> DataFrame:
    """Gather cells into dense tiles ``(extra..., col, row, cells ARRAY)``.

    Cells landing on the same position are merged first (``merge`` aggregate,
    D12), so each tile group holds at most n*n entries."""
    agg = {"max": F.max, "min": F.min, "avg": F.avg}[merge]
    keyed = cells.select(*extra, tile_of("gx", n).alias("col"), tile_of("gy", n).alias("row"),
                         ((F.col("gy") % n) * n + F.col("gx") % n).alias("pos"), F.col(value).alias("v"))
    per_cell = keyed.groupBy(*extra, "col", "row", "pos").agg(agg("v").alias("v"))
    tiles = per_cell.groupBy(*extra, "col", "row").agg(F.collect_list(F.struct("pos", "v")).alias("m"))
    return tiles.select(*extra, "col", "row", F.transform(_dense(tiles, "m", n), lambda x: x["v"]).alias("cells"))


def _dense(tiles: DataFrame, entries: str, n: int) -> F.Column:
    """The (pos, v) entries of a tile in order of pos, with a null v at each of the n*n positions that has none: a
    set difference and one sort, so the work is near-linear in n*n."""
    entry = tiles.schema[entries].dataType.elementType
    pos, v = entry["pos"].dataType, entry["v"].dataType
    gaps = F.array_except(F.sequence(F.lit(0).cast(pos), F.lit(n * n - 1).cast(pos)), F.col(entries)["pos"])
    return F.sort_array(F.concat(entries, F.transform(gaps, lambda i: F.struct(i.alias("pos"), F.lit(None).cast(v).alias("v")))))


def extent_to_keys(extents: DataFrame, col_min, col_max, row_min, row_max, keep=()) -> DataFrame:
    """One row per grid key covered by an extent (C8): a range join written
    as two bounded ``explode(sequence(..))`` — no join at all."""
    return (extents.select(*keep, F.explode(F.sequence(col_min, col_max)).alias("col"), row_min.alias("_r0"),
                           row_max.alias("_r1"))
            .select(*keep, "col", F.explode(F.sequence("_r0", "_r1")).alias("row")))


def cells_to_band_tiles(cells: DataFrame, n: int, bands: list[str], extra=()) -> DataFrame:
    """Multiband form of :func:`cells_to_tiles`: one dense array column per
    band, gathered in a single ``groupBy`` (bounded by n*n per tile)."""
    keyed = cells.select(*extra, tile_of("gx", n).alias("col"), tile_of("gy", n).alias("row"),
                         ((F.col("gy") % n) * n + F.col("gx") % n).alias("pos"), *bands)
    per_cell = keyed.groupBy(*extra, "col", "row", "pos").agg(*[F.max(b).alias(b) for b in bands])
    tiles = per_cell.groupBy(*extra, "col", "row").agg(
        F.collect_list(F.struct("pos", F.struct(*bands).alias("v"))).alias("m"))
    tiles = tiles.withColumn("m", _dense(tiles, "m", n))
    values = tiles.select(*extra, "col", "row", F.transform("m", lambda x: x["v"]).alias("v"))
    return values.select(*extra, "col", "row", *[F.col("v")[b].alias(b) for b in bands])


def band_tiles_to_cells(tiles: DataFrame, n: int, bands: list[str], keys=("col", "row"), extra=()) -> DataFrame:
    """Multiband tiles -> cells ``(extra..., gx, gy, bands...)``: the band
    arrays are zipped and exploded together; positions where every band is
    NULL (NoData) stay out."""
    z = tiles.select(*keys, *extra, F.posexplode(F.arrays_zip(*[F.col(b) for b in bands])).alias("pos", "z"))
    present = None
    for b in bands:
        c = F.col(f"z.{b}").isNotNull()
        present = c if present is None else (present | c)
    return (z.where(present)
            .select(*extra, (F.col(keys[0]) * n + F.col("pos") % n).alias("gx"),
                    (F.col(keys[1]) * n + F.floor(F.col("pos") / n)).alias("gy"),
                    *[F.col(f"z.{b}").alias(b) for b in bands]))
