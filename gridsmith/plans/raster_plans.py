"""Rasters with extents, as arrays: windowed read, layout from extents, re-tiling, reprojection both ways, mosaics."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridsmith.functions import indices as ix
from gridsmith.operators import rasters as ra
from gridsmith.operators import tiles as tl
from gridsmith.operators.geometry import EARTH_RADIUS
from gridsmith.plans.focal_plans import LAT1, LON0, RES
from gridsmith.plans.oracle import with_ctes
from gridsmith.plans.registry import ORACLE, register
from gridsmith.session import shared_dir
from gridsmith.sources import bucketed as bu
from gridsmith.sources import catalog as cat
from gridsmith.sources import fixtures as fx

SIDE = 64            # lines of a raster, and cells of a line
BUDGET = 24 * 24 * 8  # bytes of a window: 24 cells a side in multiples of 8
CELL = 30.0
LAYOUT = ra.Grid(x0=-1200.0, y0=900.0, cell=CELL, n=20, crs="mercator")

#: Rasters of up to 64 lines, placed so that neighbours overlap; the first corner is not the layout's.
LINES = f"""lines as (
select vec_id // {SIDE} as raster, vec_id % {SIDE} as row, i - 1 as c, floor(1000 * (1 + cast(e as double))) as v
from (select vec_id, generate_subscripts(embedding, 1) as i, unnest(embedding) as e from embeddings) t)"""
PLACED = f"""placed as (
select *, (raster % 7) * 48 - 20 as x, (raster // 7) * 40 + 10 * (raster % 3) - 5 as y, raster * 5 % 11 as priority from lines)"""


def raster_lines(spark, sf):
    """Scanlines ``(raster, row, values)`` with the rasters' corner, cell size, CRS and priority."""
    e = fx.read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    raster = F.floor(F.col("vec_id") / SIDE)
    x, y = (raster % 7) * 48 - 20, F.floor(raster / 7) * 40 + 10 * (raster % 3) - 5
    return e.select(raster.alias("raster"), (F.col("vec_id") % SIDE).cast("int").alias("row"),
                    F.transform("embedding", lambda v: F.floor(1000 * (1 + v.cast("double"))).cast("double")).alias("values"),
                    (F.lit(LAYOUT.x0) + x * F.lit(CELL)).alias("x_min"), (F.lit(LAYOUT.y0) - y * F.lit(CELL)).alias("y_max"),
                    F.lit(CELL).alias("cell"), F.lit(LAYOUT.crs).alias("crs"), (raster * 5 % 11).alias("priority"))


def raster_windows(spark, sf):
    keep = ("x_min", "y_max", "cell", "crs", "priority")
    w = ra.read_windows(raster_lines(spark, sf), ra.window_side(BUDGET, multiple=8), keep)
    return w.withColumn("x_min", F.col("x_min") + F.col("col_off") * F.col("cell")).withColumn(
        "y_max", F.col("y_max") - F.col("row_off") * F.col("cell"))


@register("raster_windows", with_ctes(
    f"""select raster, (c // 24 * 24)::integer as col_off, (row // 24 * 24)::integer as row_off,
               (max(c) - min(c) + 1)::integer as width, (max(row) - min(row) + 1)::integer as height,
               any_value(x + c // 24 * 24) * {CELL!r}::double + {LAYOUT.x0!r}::double as x_min,
               {LAYOUT.y0!r}::double - any_value(y + row // 24 * 24) * {CELL!r}::double as y_max,
               list(v order by row, c) as cells
        from placed group by raster, c // 24, row // 24""", extra=[LINES, PLACED]))
def q_raster_windows(spark, sf):
    """Windowed read of whole rasters under a byte budget, with the windows' extents (A5)."""
    return raster_windows(spark, sf).select("raster", "col_off", "row_off", "width", "height", "x_min", "y_max", "cells")


# DuckDB's // truncates: keys of negative cells are floored by shifting them first.
def _keyed_sql(src: str, n: int, shift: int) -> str:
    return f"""select t.col - {shift} as col, t.row - {shift} as row, list(s.v order by p.pos) as cells
        from (select distinct (gx + {n * shift}) // {n} as col, (gy + {n * shift}) // {n} as row from {src}) t
        cross join (select unnest(range({n * n})) as pos) p
        left join {src} s on s.gx = (t.col - {shift}) * {n} + p.pos % {n} and s.gy = (t.row - {shift}) * {n} + p.pos // {n}
        group by 1, 2"""


@register("tile_to_layout_extents", with_ctes(_keyed_sql("won", LAYOUT.n, 100), extra=[
    LINES, PLACED, """won as (select gx, gy, v from (
      select x + c as gx, y + row as gy, v, row_number() over (partition by x + c, y + row order by priority desc, v desc) as k
      from placed) s where k = 1)"""]))
def q_tile_to_layout_extents(spark, sf):
    """Overlapping rasters of different extents cut into the tiles of a layout; the source order decides."""
    return ra.to_layout(raster_windows(spark, sf), LAYOUT)


DEM_GRID = ra.Grid(0.0, 0.0, 1.0, fx.TILE, "mercator")
OTHER_GRID = ra.Grid(-5.0, 3.0, 1.0, 20, "mercator")


@register("retile_extents", with_ctes(_keyed_sql("moved", OTHER_GRID.n, 0), "dem", extra=[
    "moved as (select gx + 5 as gx, gy + 3 as gy, elev::double as v from dem)"]))
def q_retile_extents(spark, sf):
    """The DEM's 8-cell tiles in a layout of 20-cell tiles with another anchor."""
    return ra.retile(fx.dem_tiles(spark, sf), DEM_GRID, OTHER_GRID)


LONLAT = ra.Grid(LON0, LAT1, RES, fx.TILE, "lonlat")
MERCATOR = ra.Grid(EARTH_RADIUS * math.radians(LON0) - 12_345.0,
                   EARTH_RADIUS * math.log(math.tan(math.pi / 4 + math.radians(LAT1) / 2)) + 6_789.0, 1_700.0, 24, "mercator")
#: The same cells read as a web-mercator raster south of the equator, and a lon/lat layout for it.
METRES = ra.Grid(2_000_000.0, -3_000_000.0, 1_500.0, fx.TILE, "mercator")
DEGREES = ra.Grid(17.9, -25.9, 0.02, 24, "lonlat")
DIRECTIONS = {"to_mercator": (LONLAT, MERCATOR), "to_lonlat": (METRES, DEGREES)}


def _sampled_sql(source: ra.Grid, target: ra.Grid, method: str) -> str:
    """Every target cell around the source, back to fractional source cells, joined to the cells it is made of."""
    r = repr(EARTH_RADIUS)
    x, y = f"({target.x0!r} + (tx + 0.5) * {target.cell!r})", f"({target.y0!r} - (ty + 0.5) * {target.cell!r})"
    if target.crs == "mercator":
        sx, sy = f"degrees({x} / {r})", f"degrees(2 * atan(exp({y} / {r})) - pi() / 2)"
    else:
        sx, sy = f"{r} * radians({x})", f"{r} * ln(tan(pi() / 4 + radians({y}) / 2))"
    # a wide rectangle of target cells around the source: at most 3 source cells a target cell, and a margin
    t = f"""t as (select tx, ty, ({sx} - {source.x0!r}) / {source.cell!r} - 0.5 as sx, ({source.y0!r} - {sy}) / {source.cell!r} - 0.5 as sy
            from (select unnest(range(-40, 200)) as tx) a, (select unnest(range(-40, (select max(gy) from dem) + 200)) as ty) b)"""
    if method == "nearest":
        cells = f"""cells as (select t.tx as gx, t.ty as gy, d.elev::double as v from t join dem d
                    on d.gx = floor(t.sx + {0.5 + 1e-9!r}) and d.gy = floor(t.sy + {0.5 + 1e-9!r}))"""
    else:
        cells = """cells as (select tx as gx, ty as gy, sum(w * elev) / sum(w) as v from (
                     select t.tx, t.ty, d.elev,
                            (case when i = 1 then t.sx - floor(t.sx) else 1.0 - (t.sx - floor(t.sx)) end)
                          * (case when j = 1 then t.sy - floor(t.sy) else 1.0 - (t.sy - floor(t.sy)) end) as w
                     from t, (values (0, 0), (1, 0), (0, 1), (1, 1)) c(i, j), dem d
                     where d.gx = floor(t.sx) + i and d.gy = floor(t.sy) + j) s group by 1, 2 having sum(w) > 0)"""
    return with_ctes("select gx as tx, gy as ty, round(v, 3) as elev from cells", "dem", extra=[t, cells])


def _reprojected(spark, sf, direction: str, method: str):
    source, target = DIRECTIONS[direction]
    tiles = ra.reproject_tiles(fx.dem_tiles(spark, sf), source, target, method)
    cells = tl.tiles_to_cells(tiles, target.n, value="elev")
    return cells.select(F.col("gx").alias("tx"), F.col("gy").alias("ty"), F.round("elev", 3).alias("elev"))


def _register_reprojections() -> None:
    for direction, (source, target) in DIRECTIONS.items():
        for method in ("nearest", "bilinear"):
            register(f"reproject_tiles_{direction}_{method}", _sampled_sql(source, target, method))(
                lambda spark, sf, d=direction, m=method: _reprojected(spark, sf, d, m))


_register_reprojections()


def _mosaic(spark, sf, rule: str):
    masked = ix.cloud_masked_bands(fx.landsat(spark, sf))
    bands = list(ra.PIXEL_BANDS)
    tiles = tl.cells_to_band_tiles(masked, fx.TILE, bands, extra=("instant",))
    return tl.band_tiles_to_cells(ra.mosaic_tiles(tiles, rule, fx.TILE), fx.TILE, bands)


def _register_mosaics() -> None:
    for rule in ("bright", "valid", "greenest"):
        register(f"mosaic_{rule}_arrays", ORACLE[f"mosaic_{rule}"])(lambda spark, sf, r=rule: _mosaic(spark, sf, r))


_register_mosaics()


# Scene images of two bands, 64 x 64 cells each and at other places of the source grid; the last one may be cut short.
SCENE_BANDS = {0: "red", 1: "nir"}
SCENE_WINDOW = 24
SCENE_X, SCENE_Y = "(scene % 7) * 48", "(floor(scene / 7) % 50) * 40 + 10 * (scene % 3)"


def scene_lines(spark, sf):
    e = fx.read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    scene = F.floor(F.col("vec_id") / (2 * SIDE))
    return e.select(F.floor(F.col("vec_id") / SIDE).alias("raster"), scene.alias("scene"), (F.floor(F.col("vec_id") / SIDE) % 2).alias("band"),
                    F.make_timestamp_ntz(F.lit(1999), (1 + scene % 3).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("instant"),
                    (F.col("vec_id") % SIDE).cast("int").alias("row"),
                    F.transform("embedding", lambda v: F.floor(1000 * (1 + v.cast("double"))).cast("double")).alias("values"))


def ingest_scenes(lines, root: str, layer: str, zoom: int, source: ra.Grid, target: ra.Grid, bands: dict, x, y, size: int) -> None:
    """A batch of scene images into a catalog layer: windows, band stacks of whole windows, reprojection of each scene, the latest scene
    where scenes of one date overlap, upsert by date and tile.  A batch holds whole dates, as a tile of a date is replaced.
    ``x``, ``y``: the first cell of a scene in the source grid.  One job: no step loops over scenes or dates."""
    names = list(bands.values())
    windows = ra.read_windows(lines, size, ("scene", "instant", "band"))
    stacks = ra.stack_windows(windows, bands, keep=("scene", "instant"))
    placed = stacks.withColumns({"gx": (x + F.col("col_off")).cast("long"), "gy": (y + F.col("row_off")).cast("long")})
    tiles = ra.reproject_windows(placed, source, target, names, "bilinear", ("instant", "scene"))
    tiles = ra.overlay_tiles(tiles, target.n, names, "scene", ("instant",))
    cat.upsert_layer(tiles, root, layer, zoom, target.n, ["instant", "col", "row"], "float64", None, target)


def _ingest_sql() -> str:
    r, source, target = repr(EARTH_RADIUS), LONLAT, MERCATOR
    lines = f"""lines as (select vec_id // {2 * SIDE} as scene, (vec_id // {SIDE}) % 2 as band, vec_id % {SIDE} as row, i - 1 as c,
        floor(1000 * (1 + cast(e as double))) as v
      from (select vec_id, generate_subscripts(embedding, 1) as i, unnest(embedding) as e from embeddings) t)"""
    whole = f"""whole as (select scene, c // {SCENE_WINDOW} as wc, row // {SCENE_WINDOW} as wr from lines group by all
      having count(*) filter (band = 0) = count(*) filter (band = 1))"""
    px = f"""px as (select scene, c + {SCENE_X} as gx, row + {SCENE_Y} as gy, max(v) filter (band = 0) as red, max(v) filter (band = 1) as nir
      from lines l join whole w using (scene) where c // {SCENE_WINDOW} = wc and row // {SCENE_WINDOW} = wr group by all)"""
    x, y = f"({target.x0!r} + (tx + 0.5) * {target.cell!r})", f"({target.y0!r} - (ty + 0.5) * {target.cell!r})"
    t = f"""t as (select tx, ty, (degrees({x} / {r}) - {source.x0!r}) / {source.cell!r} - 0.5 as sx,
        ({source.y0!r} - degrees(2 * atan(exp({y} / {r})) - pi() / 2)) / {source.cell!r} - 0.5 as sy
      from (select unnest(range(-40, 2 * (select max(gx) from px)::bigint + 200)) as tx) a,
           (select unnest(range(-40, 2 * (select max(gy) from px)::bigint + 200)) as ty) b)"""
    mixed = """mixed as (select scene, tx, ty, sum(w * red) / sum(w) as red, sum(w * nir) / sum(w) as nir from (
        select t.tx, t.ty, p.scene, p.red, p.nir, (case when i = 1 then t.sx - floor(t.sx) else 1.0 - (t.sx - floor(t.sx)) end)
             * (case when j = 1 then t.sy - floor(t.sy) else 1.0 - (t.sy - floor(t.sy)) end) as w
        from t, (values (0, 0), (1, 0), (0, 1), (1, 1)) c(i, j), px p
        where p.gx = floor(t.sx) + i and p.gy = floor(t.sy) + j) s group by all having sum(w) > 0)"""
    return with_ctes("""select make_timestamp(1999, 1 + scene % 3, 1, 0, 0, 0.0) as instant, tx, ty, round(red, 3) as red, round(nir, 3) as nir
      from (select *, row_number() over (partition by scene % 3, tx, ty order by scene desc) as k from mixed) m where k = 1""",
                     extra=[lines, whole, px, t, mixed])


@register("scene_ingest", _ingest_sql())
def q_scene_ingest(spark, sf):
    """The ingest job as one flow, in two batches of which the second repeats a date: windows, stacks, reprojection, overlaps,
    upsert, and the stored layer read back."""
    root, lines = shared_dir(spark, "scene_ingest"), scene_lines(spark, sf)
    for months in ((1, 2), (2, 3)):
        ingest_scenes(lines.where(F.month("instant").isin(*months)), root, "scenes", 9, LONLAT, MERCATOR, SCENE_BANDS, F.expr(SCENE_X),
                      F.expr(SCENE_Y), SCENE_WINDOW)
    cells = tl.band_tiles_to_cells(cat.read_layer(spark, root, "scenes", 9), MERCATOR.n, ["red", "nir"], extra=("instant",))
    return cells.select("instant", F.col("gx").alias("tx"), F.col("gy").alias("ty"), F.round("red", 3).alias("red"), F.round("nir", 3).alias("nir"))


@register("join_spacetime_spatial_bucketed", ORACLE["join_spacetime_spatial"])
def q_join_spacetime_spatial_bucketed(spark, sf):
    """Each date of a tile meets the static class tile without a shuffle of the imagery: both are stored in the same buckets."""
    folder, buckets, bands = shared_dir(spark, "bucketed"), 16, ["red", "nir"]
    imagery = tl.cells_to_band_tiles(fx.landsat(spark, sf), fx.TILE, bands, extra=("instant",))
    static = tl.cells_to_band_tiles(fx.classes(spark, sf), fx.TILE, ["value", "nlcd"])
    series, layer = bu.write_series(imagery, f"{folder}/series", buckets), bu.write_static(static, f"{folder}/static", buckets)
    both = bu.join_static(spark, series, layer)
    cells = tl.band_tiles_to_cells(both, fx.TILE, [*bands, "value", "nlcd"], extra=("instant",))
    return cells.where(F.col("red").isNotNull() & F.col("value").isNotNull()).select("instant", "gx", "gy", *bands, "value", "nlcd")
