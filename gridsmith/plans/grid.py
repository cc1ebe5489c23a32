"""Grid, keys and layout queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridsmith.functions import grid as g
from gridsmith.operators import polygon
from gridsmith.operators import tiles as tl
from gridsmith.operators.geometry import WM_HALF_WIDTH, lonlat_to_mercator
from gridsmith.plans.oracle import touched_cte, with_ctes
from gridsmith.plans.registry import register
from gridsmith.sources import fixtures as fx

ZOOM = 2          # F1/F2 world: 32 px = 4 tiles of 8
MORTON_BITS = 24
KEYS_ZOOM = 7     # zoom used to key scene extents


def _morton_sql(x: str, y: str, bits: int = MORTON_BITS) -> str:
    parts = [f"(((({x}) >> {i}) & 1) << {2 * i})" for i in range(bits)]
    parts += [f"(((({y}) >> {i}) & 1) << {2 * i + 1})" for i in range(bits)]
    return "(" + " | ".join(parts) + ")"


def _morton3_sql(x: str, y: str, t: str, bits: int = 21) -> str:
    parts = []
    for k, v in enumerate((x, y, t)):
        parts += [f"(((({v}) >> {i}) & 1) << {3 * i + k})" for i in range(bits)]
    return "(" + " | ".join(parts) + ")"


@register("key_to_extent", with_ctes(
    f"""select col, row,
          round(-{WM_HALF_WIDTH!r}::double + col * {2 * WM_HALF_WIDTH / 2 ** ZOOM!r}::double, 3) as xmin,
          round(-{WM_HALF_WIDTH!r}::double + (col + 1) * {2 * WM_HALF_WIDTH / 2 ** ZOOM!r}::double, 3) as xmax,
          round({WM_HALF_WIDTH!r}::double - (row + 1) * {2 * WM_HALF_WIDTH / 2 ** ZOOM!r}::double, 3) as ymin,
          round({WM_HALF_WIDTH!r}::double - row * {2 * WM_HALF_WIDTH / 2 ** ZOOM!r}::double, 3) as ymax
        from (select distinct gx // 8 as col, gy // 8 as row from landsat) t""", "landsat"))
def q_key_to_extent(spark, sf):
    l = fx.landsat(spark, sf)
    keys = l.select(g.tile_of("gx", fx.TILE).alias("col"), g.tile_of("gy", fx.TILE).alias("row")).distinct()
    e = g.key_to_extent("col", "row", ZOOM)
    return keys.select("col", "row", *[F.round(e[k], 3).alias(k) for k in ("xmin", "xmax", "ymin", "ymax")])


@register("zorder_key", with_ctes(
    f"select distinct gx, gy, {_morton_sql('gx', 'gy')} as z from landsat", "landsat"))
def q_zorder_key(spark, sf):
    l = fx.landsat(spark, sf).select("gx", "gy").distinct()
    return l.select("gx", "gy", g.morton2("gx", "gy", MORTON_BITS).alias("z"))


@register("zorder_day_key", with_ctes(
    f"""select distinct gx // 8 as col, gy // 8 as row, instant,
          {_morton3_sql('gx // 8', 'gy // 8', "greatest(date_diff('day', date '2000-01-01', instant::date), 0)")} as z
        from landsat""", "landsat"))
def q_zorder_day_key(spark, sf):
    """(col, row, day) Z-curve; days count from 2000-01-01, earlier dates
    clamp to day 0 (the key bounds start there)."""
    l = fx.landsat(spark, sf)
    k = l.select(g.tile_of("gx", fx.TILE).alias("col"), g.tile_of("gy", fx.TILE).alias("row"), "instant").distinct()
    t = F.greatest(g.days_since_epoch("instant"), F.lit(0))
    return k.select("col", "row", "instant", g.morton3("col", "row", t).alias("z"))


@register("layer_path", with_ctes(
    f"""select col, row, concat_ws('/', 'catalog', nullif('', ''), 'landsat', '2',
              lpad(cast({_morton_sql('col', 'row', 2)} as varchar), 2, '0')) as path
        from (select distinct gx // 8 as col, gy // 8 as row from landsat) t""", "landsat"))
def q_layer_path(spark, sf):
    """Object path of each tile: non-empty pieces joined by '/', the key
    index zero-padded to the width of the largest index (B23, T8)."""
    l = fx.landsat(spark, sf)
    k = l.select(g.tile_of("gx", fx.TILE).alias("col"), g.tile_of("gy", fx.TILE).alias("row")).distinct()
    width = g.index_width(g.max_morton2(ZOOM))
    idx = g.morton2("col", "row", ZOOM)
    pieces = [F.lit("catalog"), F.nullif(F.lit(""), F.lit("")), F.lit("landsat"), F.lit(str(ZOOM)), g.padded_index(idx, width)]
    return k.select("col", "row", F.concat_ws("/", *pieces).alias("path"))


@register("tiles_to_cells", with_ctes("select gx, gy, elev from dem", "dem"))
def q_tiles_to_cells(spark, sf):
    return tl.tiles_to_cells(fx.dem_tiles(spark, sf), fx.TILE, value="elev")


DENSE = """select {extra}t.col, t.row, list(c.v order by p.i) as cells
  from (select distinct {extra}{gx} // {n} as col, {gy} // {n} as row from {src}) t
  cross join range(0, {nn}) p(i)
  left join (select {extra}{gx} // {n} as col, {gy} // {n} as row, ({gy} % {n}) * {n} + {gx} % {n} as pos,
                    max({val}) as v from {src} group by all) c
    on c.col = t.col and c.row = t.row and c.pos = p.i {extra_on}
  group by all"""


def _dense_sql(src, val, n, gx="gx", gy="gy", extra=""):
    extra_on = " ".join(f"and c.{e} = t.{e}" for e in extra.split(",") if e.strip())
    ex = "".join(f"{e.strip()}, " for e in extra.split(",") if e.strip())
    q = DENSE.format(extra=ex, gx=gx, gy=gy, n=n, nn=n * n, src=src, val=val, extra_on=extra_on)
    return q.replace("select distinct " + ex, "select distinct " + ex).replace("select " + ex + "t.col", "select " + "".join(f"t.{e.strip()}, " for e in extra.split(",") if e.strip()) + "t.col")


@register("cells_to_tiles", with_ctes(_dense_sql("dem", "elev", 8), "dem"))
def q_cells_to_tiles(spark, sf):
    return tl.cells_to_tiles(fx.dem(spark, sf), fx.TILE, value="elev")


@register("tile_to_layout", with_ctes(_dense_sql("landsat", "red", 8, extra="instant"), "landsat"))
def q_tile_to_layout(spark, sf):
    """Cut the red band into 8-cell layout tiles per date."""
    return tl.cells_to_tiles(fx.landsat(spark, sf), fx.TILE, value="red", extra=("instant",))


@register("retile", with_ctes(_dense_sql("classes", "value", 16), "classes"))
def q_retile(spark, sf):
    """Re-tile the class layer from 8- to 16-cell tiles (W7): back to cells,
    then regroup by the new layout keys."""
    tiles8 = tl.cells_to_tiles(fx.classes(spark, sf), fx.TILE, value="value")
    cells = tl.tiles_to_cells(tiles8, fx.TILE, value="value")
    return tl.cells_to_tiles(cells, 16, value="value")


def _scene_key_bounds(z: int):
    n = 2 ** z
    lon0 = F.col("lon10") / F.lit(10.0)
    lat0 = F.col("lat10") / F.lit(10.0)
    col = lambda lon: F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(n)))
    _, y0 = lonlat_to_mercator(lon0, lat0)
    _, y1 = lonlat_to_mercator(lon0, lat0 + F.lit(2.0))
    row = lambda y: F.floor((F.lit(WM_HALF_WIDTH) - y) / F.lit(2 * WM_HALF_WIDTH / n))
    return col(lon0), col(lon0 + F.lit(2.0)), row(y1), row(y0)


@register("extent_to_keys", with_ctes(
    f"""select scene_id, col, row from (
          select scene_id, c0, c1, r0, r1 from (
            select scene_id,
              floor((lon10 / 10.0::double + 180.0::double) / 360.0::double * {float(2 ** KEYS_ZOOM)!r}) as c0,
              floor((lon10 / 10.0::double + 2.0::double + 180.0::double) / 360.0::double * {float(2 ** KEYS_ZOOM)!r}) as c1,
              floor(({WM_HALF_WIDTH!r} - 6378137.0::double * ln(tan({math.pi / 4!r} + radians(lat10 / 10.0::double + 2.0::double) / 2))) / {2 * WM_HALF_WIDTH / 2 ** KEYS_ZOOM!r}) as r0,
              floor(({WM_HALF_WIDTH!r} - 6378137.0::double * ln(tan({math.pi / 4!r} + radians(lat10 / 10.0::double) / 2))) / {2 * WM_HALF_WIDTH / 2 ** KEYS_ZOOM!r}) as r1
            from scenes) a) b,
          unnest(range(c0::bigint, c1::bigint + 1)) u(col), unnest(range(r0::bigint, r1::bigint + 1)) v(row)""",
    "scenes"))
def q_extent_to_keys(spark, sf):
    s = fx.scenes(spark, sf)
    c0, c1, r0, r1 = _scene_key_bounds(KEYS_ZOOM)
    return tl.extent_to_keys(s, c0, c1, r0, r1, keep=("scene_id",))


@register("tiles_intersecting", with_ctes(
    "select distinct col, row, instant from t where (col, row) in (select (col, row) from touched)",
    "landsat", "aoi_edges",
    extra=[touched_cte("landsat"), "t as (select gx // 8 as col, gy // 8 as row, instant from landsat)"]))
def q_tiles_intersecting(spark, sf):
    """Tiles (and dates) touched by the polygons, at tile grain."""
    l = fx.landsat(spark, sf)
    tiles = l.select(g.tile_of("gx", fx.TILE).alias("col"), g.tile_of("gy", fx.TILE).alias("row"), "instant").distinct()
    return polygon.tiles_touched(tiles, fx.aoi_edges(spark), fx.TILE)
