"""Terrain, pyramids, reprojection and halo queries on the DEM (F3) and
class layer (F2)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridsmith.operators import focal
from gridsmith.plans.oracle import with_ctes
from gridsmith.plans.registry import r6, register
from gridsmith.sources import fixtures as fx

AZIMUTH, ALTITUDE, Z_FACTOR, CELL_SIZE = 99.0, 33.0, 1.0, 100.0
DEM_ZOOM, DEM_LEVELS = 7, 5
LON0, LAT1, RES, TARGET_M = -100.0, 40.0, 0.01, 2000.0
R = 6378137.0

_SLOTS = {(dx, dy): f"n_{dx + 1}{dy + 1}" for dx, dy in focal.OFFSETS}
_WIN_JOINS = "\n".join(
    f"left join dem {a} on {a}.gx = c.gx + ({dx}) and {a}.gy = c.gy + ({dy})"
    for (dx, dy), a in _SLOTS.items() if (dx, dy) != (0, 0))
_WIN_COLS = ", ".join(f"coalesce({a}.elev, c.elev)::double as {a}" if (dx, dy) != (0, 0) else f"c.elev::double as {a}"
                      for (dx, dy), a in _SLOTS.items())
K = Z_FACTOR / (8.0 * CELL_SIZE)


def _n(dx, dy):
    return _SLOTS[(dx, dy)]


GRAD = f"""grad as (select gx, gy,
  (({_n(1, -1)} + 2 * {_n(1, 0)} + {_n(1, 1)}) - ({_n(-1, -1)} + 2 * {_n(-1, 0)} + {_n(-1, 1)})) * {K!r} as dx,
  (({_n(-1, 1)} + 2 * {_n(0, 1)} + {_n(1, 1)}) - ({_n(-1, -1)} + 2 * {_n(0, -1)} + {_n(1, -1)})) * {K!r} as dy
  from (select c.gx, c.gy, {_WIN_COLS} from dem c
{_WIN_JOINS}) w)"""


@register("slope_components", with_ctes("select gx, gy, round(dx, 6) as dx, round(dy, 6) as dy from grad", "dem",
                                        extra=[GRAD]))
def q_slope_components(spark, sf):
    g = focal.horn_gradients(focal.neighbourhood(fx.dem(spark, sf), "elev"), CELL_SIZE, Z_FACTOR)
    return g.select("gx", "gy", r6("dx"), r6("dy"))


_az, _alt = math.radians(AZIMUTH), math.radians(ALTITUDE)


@register("hillshade", with_ctes(
    f"""select gx, gy, round(255.0::double * greatest(0.0::double,
          ({math.sin(_alt)!r} - dx * {math.sin(_az) * math.cos(_alt)!r} + dy * {math.cos(_az) * math.cos(_alt)!r})
          / sqrt(1.0::double + dx * dx + dy * dy)), 6) as hillshade from grad""", "dem", extra=[GRAD]))
def q_hillshade(spark, sf):
    hs = focal.hillshade(fx.dem(spark, sf), "elev", AZIMUTH, ALTITUDE, Z_FACTOR, CELL_SIZE)
    return hs.select("gx", "gy", r6("hillshade"))


def _pyramid_sql(src: str, value: str, zoom: int, levels: int, method: str) -> tuple[list[str], str]:
    ctes = [f"l{zoom} as (select gx, gy, {value} as value from {src})"]
    for z in range(zoom - 1, zoom - levels - 1, -1):
        if method == "bilinear":
            ctes.append(f"l{z} as (select gx // 2 as gx, gy // 2 as gy, avg(value) as value from l{z + 1} "
                        "where value is not null group by all)")
        else:
            ctes.append(f"""l{z} as (select gx, gy, value from (
              select gx // 2 as gx, gy // 2 as gy, value,
                     row_number() over (partition by gx // 2, gy // 2 order by (gy % 2) * 2 + gx % 2 desc) as rn
              from l{z + 1}) t where rn = 1)""")
    body = " union all ".join(f"select {z} as zoom, gx, gy, round(value, 6) as value from l{z}"
                              for z in range(zoom, zoom - levels - 1, -1))
    return ctes, body


_bil_ctes, _bil_body = _pyramid_sql("dem", "elev", DEM_ZOOM, DEM_LEVELS, "bilinear")


@register("pyramid_bilinear", with_ctes(_bil_body, "dem", extra=_bil_ctes))
def q_pyramid_bilinear(spark, sf):
    p = focal.pyramid(fx.dem(spark, sf), "elev", DEM_ZOOM, DEM_ZOOM - DEM_LEVELS, "bilinear")
    return p.select("zoom", "gx", "gy", r6(F.col("value").cast("double"), "value"))


_near_ctes, _near_body = _pyramid_sql("classes", "value", 2, 2, "nearest")


@register("pyramid_nearest", with_ctes(_near_body.replace("round(value, 6)", "value"), "classes", extra=_near_ctes))
def q_pyramid_nearest(spark, sf):
    """Class layers resample by nearest: NoData (0) children count too."""
    return focal.pyramid(fx.classes(spark, sf), "value", 2, 0, "nearest")


def _merc_y(lat: str) -> str:
    return f"({R!r} * ln(tan({math.pi / 4!r} + radians({lat}) / 2)))"


REPROJ = f"""b as (select max(gx) as mx, max(gy) as my from dem),
g as (select tx, ty from b,
  unnest(range(0, floor(({R!r} * radians({LON0!r} + (mx + 1) * {RES!r}) - {R!r} * radians({LON0!r}::double)) / {TARGET_M!r})::bigint)) a(tx),
  unnest(range(0, floor(({_merc_y(f'{LAT1!r}::double')} - {_merc_y(f'({LAT1!r} - (my + 1) * {RES!r})')}) / {TARGET_M!r})::bigint)) c(ty)),
t as (select tx, ty,
  (degrees(({R!r} * radians({LON0!r}::double) + (tx + 0.5) * {TARGET_M!r}) / {R!r}) - {LON0!r}) / {RES!r} - 0.5 as sx,
  ({LAT1!r} - degrees(2 * atan(exp(({_merc_y(f'{LAT1!r}::double')} - (ty + 0.5) * {TARGET_M!r}) / {R!r})) - {math.pi / 2!r})) / {RES!r} - 0.5 as sy
  from g)"""


@register("reproject_nearest", with_ctes(
    f"""select t.tx, t.ty, d.elev from t join dem d
        on d.gx = floor(t.sx + {0.5 + 1e-9!r}) and d.gy = floor(t.sy + {0.5 + 1e-9!r})""", "dem", extra=[REPROJ]))
def q_reproject_nearest(spark, sf):
    return focal.reproject_lonlat_to_mercator(fx.dem(spark, sf), "elev", LON0, LAT1, RES, TARGET_M, "nearest")


@register("reproject_bilinear", with_ctes(
    """select tx, ty, round(sum(w * elev) / nullif(sum(w), 0), 3) as elev from (
         select t.tx, t.ty, d.elev,
                (case when i = 1 then t.sx - floor(t.sx) else 1.0 - (t.sx - floor(t.sx)) end)
              * (case when j = 1 then t.sy - floor(t.sy) else 1.0 - (t.sy - floor(t.sy)) end) as w
         from t, (values (0, 0), (1, 0), (0, 1), (1, 1)) c(i, j), dem d
         where d.gx = floor(t.sx) + i and d.gy = floor(t.sy) + j) x group by tx, ty""", "dem", extra=[REPROJ]))
def q_reproject_bilinear(spark, sf):
    r = focal.reproject_lonlat_to_mercator(fx.dem(spark, sf), "elev", LON0, LAT1, RES, TARGET_M, "bilinear")
    # Elevation to 3 decimals: the two engines' radians() differ in the last bit.
    return r.select("tx", "ty", F.round("elev", 3).alias("elev"))


@register("tile_halo", with_ctes(
    """select s.* from (
         select t.col + d.dc as col, t.row + d.dr as row, -d.dc as dcol, -d.dr as drow,
                list(c.elev order by c.gy % 8, c.gx % 8) as strip
         from dem c join tiles t on t.col = c.gx // 8 and t.row = c.gy // 8, dirs d
         where (d.dc = 0 or (d.dc > 0 and c.gx % 8 >= 7) or (d.dc < 0 and c.gx % 8 < 1))
           and (d.dr = 0 or (d.dr > 0 and c.gy % 8 >= 7) or (d.dr < 0 and c.gy % 8 < 1))
         group by all) s where (s.col, s.row) in (select col, row from tiles)""", "dem",
    extra=["tiles as (select distinct gx // 8 as col, gy // 8 as row from dem)",
           "dirs as (select * from (values (-1, -1), (0, -1), (1, -1), (-1, 0), (1, 0), (-1, 1), (0, 1), (1, 1)) d(dc, dr))"]))
def q_tile_halo(spark, sf):
    return focal.tile_halo(fx.dem_tiles(spark, sf), fx.TILE, 1)


def _relief(a):
    """Elevation above the tile's lowest cell (a tile-local numpy function)."""
    import numpy as np
    return (a - np.min(a)).astype("int64")


@register("map_tiles", with_ctes(
    """select vec_id % 16 as col, vec_id // 16 as row,
              list_transform(c, lambda x: x - list_min(c)) as cells
       from (select vec_id, list_transform(embedding, lambda e: cast(floor(1000 * (1 + cast(e as double))) as bigint)) as c
             from embeddings) t""", ))
def q_map_tiles(spark, sf):
    from gridsmith.operators.tile_map import map_tiles
    return map_tiles(fx.dem_tiles(spark, sf), _relief, fx.TILE)
