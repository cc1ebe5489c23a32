"""Focal (neighbourhood) operators, resampling pyramids and reprojection.

Neighbourhoods at cell grain use a *scatter-gather*: every cell sends its
value to the (up to) 9 cells whose 3x3 window contains it, tagged with its
slot, and one ``groupBy(target)`` with conditional aggregates rebuilds each
window.  That is one shuffle, no window-function partition per grid line,
gaps and raster edges handled by NULL slots.  Spark's partial aggregation
merges the 9 copies inside a task first, so when the input is spatially
clustered (Z-order layout) only the task borders really shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.operators.geometry import EARTH_RADIUS, mercator_lat, mercator_to_lonlat, mercator_y

OFFSETS = [(dx, dy) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def _slot(dx: int, dy: int) -> str:
    return f"n{'m' if dx < 0 else ('p' if dx > 0 else 'z')}{'m' if dy < 0 else ('p' if dy > 0 else 'z')}"


def neighbourhood(cells: DataFrame, value: str, keys=("gx", "gy")) -> DataFrame:
    """``(gx, gy, n<dx><dy> ...)``: the 3x3 window of every present cell;
    slot ``nmz`` is the left neighbour (dx=-1, dy=0), ``nzz`` the centre."""
    gx, gy = keys
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in OFFSETS])
    sent = cells.select(F.col(gx), F.col(gy), F.col(value).alias("v"), F.explode(offs).alias("o"))
    sent = sent.select((F.col(gx) - F.col("o.dx")).alias(gx), (F.col(gy) - F.col("o.dy")).alias(gy),
                       "o.dx", "o.dy", "v")
    aggs = [F.max(F.when((F.col("dx") == dx) & (F.col("dy") == dy), F.col("v"))).alias(_slot(dx, dy))
            for dx, dy in OFFSETS]
    return sent.groupBy(gx, gy).agg(*aggs).where(F.col("nzz").isNotNull())


def horn_gradients(win: DataFrame, cell_size: float = 1.0, z_factor: float = 1.0) -> DataFrame:
    """Horn's 3x3 gradients ``dx`` (east) and ``dy`` (down); a missing
    neighbour takes the centre value [ours]."""
    n = {(dx, dy): F.coalesce(F.col(_slot(dx, dy)), F.col("nzz")).cast("double") for dx, dy in OFFSETS}
    k = F.lit(float(z_factor) / (8.0 * float(cell_size)))
    ddx = ((n[(1, -1)] + 2 * n[(1, 0)] + n[(1, 1)]) - (n[(-1, -1)] + 2 * n[(-1, 0)] + n[(-1, 1)])) * k
    ddy = ((n[(-1, 1)] + 2 * n[(0, 1)] + n[(1, 1)]) - (n[(-1, -1)] + 2 * n[(0, -1)] + n[(1, -1)])) * k
    return win.select("gx", "gy", ddx.alias("dx"), ddy.alias("dy"))


def hillshade(cells: DataFrame, value: str, azimuth: float = 99.0, altitude: float = 33.0,
              z_factor: float = 1.0, cell_size: float = 1.0) -> DataFrame:
    """Hillshade 0..255 (W1): light vector dotted with the surface normal,
    ``255 * max(0, (sin(alt) - dx sin(az) cos(alt) + dy cos(az) cos(alt)) / sqrt(1 + dx^2 + dy^2))``.
    Cell-grain form; for tiled layers at scale use ``tile_grain.hillshade``
    (halo exchange, ~1 + 4/n of the data shuffled instead of up to 9x)."""
    g = horn_gradients(neighbourhood(cells, value), cell_size, z_factor)
    az, alt = math.radians(azimuth), math.radians(altitude)
    num = (F.lit(math.sin(alt)) - F.col("dx") * F.lit(math.sin(az) * math.cos(alt))
           + F.col("dy") * F.lit(math.cos(az) * math.cos(alt)))
    hs = F.lit(255.0) * F.greatest(F.lit(0.0), num / F.sqrt(F.lit(1.0) + F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
    return g.select("gx", "gy", hs.alias("hillshade"))


def pyramid(cells: DataFrame, value: str, zoom: int, to: int = 0, method: str = "nearest",
            materialize: bool | None = None) -> DataFrame:
    """All levels ``zoom..to`` as ``(zoom, gx, gy, value)``.

    Each level is one partial-aggregated ``groupBy(gx div 2, gy div 2)`` of
    the previous one; the levels are unioned lazily, and Spark reuses the
    shared exchanges so every level is computed once.
    * ``bilinear``: mean of the non-NULL children (exact half scale).
    * ``nearest``: the present child with the largest ``(gy%2)*2 + gx%2``.

    ``materialize`` (default: when more than 3 levels are built) checkpoints
    each level to the shared checkpoint folder before the next one reads it:
    every level is computed exactly once, the plan stays linear in depth,
    and a lost executor recomputes at most one level.
    """
    from gridsmith.session import cut_lineage
    if materialize is None:
        materialize = (zoom - to) > 3
    lvl = cells.select("gx", "gy", F.col(value).alias("value"))
    out = lvl.select(F.lit(zoom).alias("zoom"), "gx", "gy", "value")
    for z in range(zoom - 1, to - 1, -1):
        parent = [F.floor(F.col("gx") / 2).alias("gx"), F.floor(F.col("gy") / 2).alias("gy")]
        if method == "bilinear":
            lvl = lvl.where(F.col("value").isNotNull()).groupBy(*parent).agg(F.avg("value").alias("value"))
        elif method == "nearest":
            parity = (F.col("gy") % 2) * 2 + F.col("gx") % 2
            lvl = lvl.groupBy(*parent).agg(F.max_by("value", parity).alias("value"))
        else:
            raise ValueError(method)
        if materialize:
            lvl = cut_lineage(lvl)
        out = out.unionByName(lvl.select(F.lit(z).alias("zoom"), "gx", "gy", "value"))
    return out


def reproject_lonlat_to_mercator(cells: DataFrame, value: str, lon0: float, lat1: float, res_deg: float,
                                 target_size_m: float, method: str = "nearest",
                                 max_gx: int | None = None, max_gy: int | None = None) -> DataFrame:
    """Resample a lon/lat grid (pixel (gx,gy) centre at ``lon0 + (gx+.5) res``,
    ``lat1 - (gy+.5) res``) onto a web-mercator grid with ``target_size_m``
    pixels whose origin is the source's top-left corner (W5).

    Inverse mapping: the target grid size comes from the source bounds (one
    aggregate row), the grid itself from ``spark.range``; each target centre is
    mapped back to source pixel space with column math, and the values are
    fetched with an equi-join (nearest) or a 4-corner join with weights
    renormalised over the present corners (bilinear).

    A source grid may reach past a pole (a table of any size is a grid of any height): the target then ends at
    ``MAX_LAT``, and source cells beyond the pole, which have no place in web-mercator, are in no target cell."""
    # Target grid size from the source bounds: given (e.g. from the layer's
    # metadata row) or one aggregate over the source.
    if max_gx is None or max_gy is None:
        mx, my = cells.agg(F.max("gx"), F.max("gy")).first()
    else:
        mx, my = max_gx, max_gy
    if mx is None:
        return cells.sparkSession.createDataFrame([], f"tx bigint, ty bigint, {value} double")
    r = EARTH_RADIUS
    x0 = r * math.radians(lon0)
    y0 = mercator_y(lat1)
    x1 = r * math.radians(lon0 + (mx + 1) * res_deg)
    y1 = mercator_y(lat1 - (my + 1) * res_deg)
    ntx, nty = int(math.floor((x1 - x0) / target_size_m)), int(math.floor((y0 - y1) / target_size_m))
    # The target grid is generated in parallel by spark.range (no single
    # task ever holds it); tx/ty come from the row id.
    spark = cells.sparkSession
    grid = spark.range(0, max(ntx, 0) * max(nty, 0)).select((F.col("id") % ntx).alias("tx"),
                                                            F.floor(F.col("id") / ntx).alias("ty"))
    y_top, x0, y0 = y0, F.lit(x0), F.lit(y0)
    s = F.lit(float(target_size_m))
    cx = x0 + (F.col("tx") + F.lit(0.5)) * s
    cy = y0 - (F.col("ty") + F.lit(0.5)) * s
    lon, lat = mercator_to_lonlat(cx, cy)
    sx = (lon - F.lit(lon0)) / F.lit(res_deg) - F.lit(0.5)
    sy = (F.lit(lat1) - lat) / F.lit(res_deg) - F.lit(0.5)
    t = grid.select("tx", "ty", sx.alias("sx"), sy.alias("sy"))
    src = cells.select(F.col("gx"), F.col("gy"), F.col(value).alias("v"))
    # Target rows take cells from the lines between the target's edges only (two lines are for the corners and rounding):
    # lines past a pole meet none of them in the join and need not be shuffled.
    first, last = (math.floor((lat1 - mercator_lat(y)) / res_deg) for y in (y_top, y1))
    src = src.where(F.col("gy").between(first - 2, last + 2))
    if method == "nearest":
        t = t.select("tx", "ty", F.floor(F.col("sx") + F.lit(0.5 + 1e-9)).alias("gx"),
                     F.floor(F.col("sy") + F.lit(0.5 + 1e-9)).alias("gy"))
        return t.join(src, ["gx", "gy"]).select("tx", "ty", F.col("v").alias(value))
    fx0, fy0 = F.floor(F.col("sx")), F.floor(F.col("sy"))
    ax, ay = F.col("sx") - fx0, F.col("sy") - fy0
    corners = F.array(*[F.struct((fx0 + i).alias("gx"), (fy0 + j).alias("gy"),
                                 ((ax if i else (F.lit(1.0) - ax)) * (ay if j else (F.lit(1.0) - ay))).alias("w"))
                        for j in (0, 1) for i in (0, 1)])
    c = t.select("tx", "ty", F.explode(corners).alias("c")).select("tx", "ty", "c.gx", "c.gy", "c.w")
    j = c.join(src, ["gx", "gy"])
    return j.groupBy("tx", "ty").agg(F.try_divide(F.sum(F.col("w") * F.col("v")), F.sum("w")).alias(value))


def tile_halo(tiles: DataFrame, n: int, halo: int = 1, cells: str = "cells", only_existing: bool = True) -> DataFrame:
    """Tile grain halo exchange (W2): every tile receives the ``halo``-wide
    border strips of its (up to 8) neighbours.  Each tile sends each strip
    only to the neighbour that needs it (``explode`` of <= 8 targets), and
    one ``groupBy(target)`` gathers them: output ``(col, row, dcol, drow,
    strip ARRAY)`` rows, at most 8 per tile (bounded)."""
    h = halo

    def strip(dc: int, dr: int):
        # Cells of the sender that the neighbour at (dc, dr) needs.
        xs = range(n - h, n) if dc > 0 else (range(0, h) if dc < 0 else range(0, n))
        ys = range(n - h, n) if dr > 0 else (range(0, h) if dr < 0 else range(0, n))
        return F.array(*[F.element_at(cells, y * n + x + 1) for y in ys for x in xs])

    targets = F.array(*[F.struct(F.lit(dc).alias("dc"), F.lit(dr).alias("dr"), strip(dc, dr).alias("s"))
                        for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dc, dr) != (0, 0)])
    sent = tiles.select("col", "row", F.explode(targets).alias("t"))
    # The receiver sees the strip as coming from direction (-dc, -dr).
    got = sent.select((F.col("col") + F.col("t.dc")).alias("col"), (F.col("row") + F.col("t.dr")).alias("row"),
                      (-F.col("t.dc")).alias("dcol"), (-F.col("t.dr")).alias("drow"), F.col("t.s").alias("strip"))
    # Strips addressed to tiles that do not exist are dropped (callers that
    # gather strips with their own tile anyway can skip this join).
    if not only_existing:
        return got
    return got.join(tiles.select("col", "row"), ["col", "row"], "left_semi")
