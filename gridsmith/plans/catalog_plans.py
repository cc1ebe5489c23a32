"""Catalog queries: each writes layers derived from the tables into a fresh
folder under the shared checkpoint location, then reads them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridsmith.operators import band_pyramid as bp
from gridsmith.operators import focal
from gridsmith.operators import tiles as tl
from gridsmith.operators.rasters import Grid
from gridsmith.plans.focal_plans import DEM_LEVELS, DEM_ZOOM, _pyramid_sql
from gridsmith.plans.ingest_plans import FOOTPRINTS
from gridsmith.plans.oracle import touched_cte, with_ctes
from gridsmith.plans.grid import _dense_sql
from gridsmith.plans.registry import ORACLE, r6, register
from gridsmith.session import cut_lineage, shared_dir
from gridsmith.sources import catalog as cat
from gridsmith.sources import fixtures as fx
from gridsmith.sources import scenes as sc

ZOOM = 2
_dense_dem_sql = _dense_sql("dem", "elev", 8)
LANDSAT_COLS = ["instant", "gx", "gy", "blue", "green", "red", "nir", "qa"]
Q_FROM, Q_TO = dt.datetime(1997, 1, 1), dt.datetime(1999, 12, 31)
Q_POLY = 1  # touches two tiles without a cell centre inside


def _catalog(spark, sf, with_classes: bool = True):
    root = shared_dir(spark, "catalog")
    cat.write_layer(fx.landsat(spark, sf), root, "landsat", ZOOM, fx.TILE, "uint16", 0)
    if with_classes:
        cat.write_layer(fx.classes(spark, sf), root, "classes", ZOOM, fx.TILE, "uint8", 0)
    return root


@register("layer_scan", with_ctes("select * from landsat", "landsat"))
def q_layer_scan(spark, sf):
    root = _catalog(spark, sf, with_classes=False)
    return cat.read_layer(spark, root, "landsat", ZOOM).select(*LANDSAT_COLS)


@register("layer_write_read", with_ctes("select gx, gy, value, nlcd from classes", "classes"))
def q_layer_write_read(spark, sf):
    root = shared_dir(spark, "catalog")
    cat.write_layer(fx.classes(spark, sf), root, "classes", ZOOM, fx.TILE, "uint8", 0)
    return cat.read_layer(spark, root, "classes", ZOOM).select("gx", "gy", "value", "nlcd")


@register("layer_query", with_ctes(
    f"""select * from landsat where instant between '{Q_FROM}' and '{Q_TO}'
        and (gx // 8, gy // 8) in (select (col, row) from touched where poly_id = {Q_POLY})""",
    "landsat", "aoi_edges", extra=[touched_cte("landsat")]))
def q_layer_query(spark, sf):
    root = _catalog(spark, sf, with_classes=False)
    edges = fx.aoi_edges(spark).where(F.col("poly_id") == Q_POLY)
    return cat.query_layer(spark, root, "landsat", ZOOM, fx.TILE, edges, (Q_FROM, Q_TO)).select(*LANDSAT_COLS)


@register("layer_exists", with_ctes(
    """select concat('part_', v) as layer, zoom, v in (select nlcd from classes) and zoom = 2 as "exists"
       from (select value as v from classes union select nlcd from classes) a, (values (2), (3)) z(zoom)""", "classes"))
def q_layer_exists(spark, sf):
    """One layer per land-cover code is written; every code and value that the tables hold is asked for, at two zooms."""
    root, cells = shared_dir(spark, "catalog"), cut_lineage(fx.classes(spark, sf))
    for code in (11, 22, 82):
        part = cells.where(F.col("nlcd") == code)
        if not part.isEmpty():
            cat.write_layer(part, root, f"part_{code}", ZOOM, fx.TILE, "uint8", 0)
    asked = cells.select(F.col("value").alias("v")).union(cells.select("nlcd")).distinct()
    asked = asked.select(F.concat(F.lit("part_"), F.col("v").cast("string")).alias("layer"), F.explode(F.array(F.lit(2), F.lit(3))).alias("zoom"))
    return cat.layer_exists(spark, root, asked)


UPSERT_SQL = """select instant, gx, gy, blue, green, red,
  case when year(instant) >= 1998 then nir + 1 else nir end as nir, qa from landsat"""


def _upsert_batches(spark, sf):
    l = fx.landsat(spark, sf)
    b1 = l.where(F.year("instant") <= 1998)
    b2 = l.where(F.year("instant") >= 1998).withColumn("nir", F.col("nir") + 1)
    return b1, b2


@register("layer_upsert", with_ctes(UPSERT_SQL, "landsat"))
def q_layer_upsert(spark, sf):
    """Create with batch 1, upsert batch 2 (overlapping 1998): new keys are
    added, existing keys replaced (A10)."""
    root = shared_dir(spark, "catalog")
    b1, b2 = _upsert_batches(spark, sf)
    keys = ["instant", "gx", "gy"]
    cat.upsert_layer(b1, root, "landsat", ZOOM, fx.TILE, keys)
    cat.upsert_layer(b2, root, "landsat", ZOOM, fx.TILE, keys)
    return cat.read_layer(spark, root, "landsat", ZOOM).select(*LANDSAT_COLS)


META_SQL = """select 'landsat' as layer, 2 as zoom, 8 as tile_size, 'uint16' as cell_type, 0 as nodata,
  min(gx // 8) as col_min, max(gx // 8) as col_max, min(gy // 8) as row_min, max(gy // 8) as row_max,
  min(instant) as instant_min, max(instant) as instant_max, count(*) as cells, 'lonlat' as crs,
  -100.0::double + min(gx // 8) * 0.25::double as x_min, 40.0::double - (max(gy // 8) + 1) * 0.25::double as y_min,
  -100.0::double + (max(gx // 8) + 1) * 0.25::double as x_max, 40.0::double - min(gy // 8) * 0.25::double as y_max from {src}"""
LANDSAT_GRID = Grid(-100.0, 40.0, 0.25 / fx.TILE, fx.TILE, "lonlat")


@register("collect_metadata", with_ctes(META_SQL.format(src="landsat"), "landsat"))
def q_collect_metadata(spark, sf):
    return cat.layer_meta(fx.landsat(spark, sf), "landsat", ZOOM, fx.TILE, "uint16", 0, LANDSAT_GRID)


@register("merge_metadata", with_ctes(
    META_SQL.format(src="(select * from landsat where year(instant) <= 1998 union all "
                        "select * from landsat where year(instant) >= 1998)"), "landsat"))
def q_merge_metadata(spark, sf):
    b1, b2 = _upsert_batches(spark, sf)
    m1 = cat.layer_meta(b1, "landsat", ZOOM, fx.TILE, "uint16", 0, LANDSAT_GRID)
    m2 = cat.layer_meta(b2, "landsat", ZOOM, fx.TILE, "uint16", 0, LANDSAT_GRID)
    return cat.merge_meta(m1, m2).select(*cat.META_COLS)


_pc, _pb = _pyramid_sql("dem", "elev", DEM_ZOOM, DEM_LEVELS, "bilinear")


@register("pyramid_write", with_ctes(f"select * from ({_pb}) p where zoom < {DEM_ZOOM}", "dem", extra=_pc))
def q_pyramid_write(spark, sf):
    """Write every pyramid level below the base, deepest first in one
    partitioned write, then read all levels back (A12)."""
    root = shared_dir(spark, "pyramid")
    p = focal.pyramid(fx.dem(spark, sf), "elev", DEM_ZOOM, DEM_ZOOM - DEM_LEVELS, "bilinear")
    p = p.where(F.col("zoom") < DEM_ZOOM).withColumn("layer", F.lit("dem"))
    p.write.mode("overwrite").partitionBy("layer", "zoom").parquet(root)
    back = spark.read.parquet(root).where(F.col("layer") == "dem")
    return back.select(F.col("zoom").cast("int").alias("zoom"), "gx", "gy", r6(F.col("value").cast("double"), "value"))


PYRAMID_ZOOM, PYRAMID_BANDS = 9, ["red", "nir"]
_LEVELS = f"""levels as (
  select instant, z as zoom, gx // (1 << ({PYRAMID_ZOOM} - z)) as gx, gy // (1 << ({PYRAMID_ZOOM} - z)) as gy, avg(red) as red, avg(nir) as nir
  from (select instant, gx, gy, red, case when qa >> 14 <> 3 then nir end as nir from landsat) l, range(0, {PYRAMID_ZOOM + 1}) t(z)
  group by all)"""


def _band_pyramid(spark, sf):
    """Two bands of the imagery per date, clouds missing in one of them, as a pyramid of ten levels in a catalog."""
    root = shared_dir(spark, "band_pyramid")
    l = fx.landsat(spark, sf).select("instant", "gx", "gy", "red", F.when(F.shiftright("qa", 14) != 3, F.col("nir")).alias("nir"))
    tiles = tl.cells_to_band_tiles(l, fx.TILE, PYRAMID_BANDS, extra=("instant",))
    bp.write_pyramid(cut_lineage(tiles), root, "landsat", fx.TILE, PYRAMID_ZOOM, PYRAMID_BANDS, grid=LANDSAT_GRID)
    return root


@register("band_pyramid_catalog", with_ctes(
    "select instant, zoom::integer as zoom, gx, gy, round(red, 6) as red, round(nir, 6) as nir from levels", "landsat", extra=[_LEVELS]))
def q_band_pyramid_catalog(spark, sf):
    """All levels of a multiband space-time pyramid, written as catalog layers and read back."""
    root, out = _band_pyramid(spark, sf), None
    for z in range(PYRAMID_ZOOM, -1, -1):
        tiles = cat.read_layer(spark, root, "landsat", z)
        cells = tl.band_tiles_to_cells(tiles, fx.TILE, PYRAMID_BANDS, extra=("instant",)).withColumn("zoom", F.lit(z))
        out = cells if out is None else out.unionByName(cells)
    return out.select("instant", "zoom", "gx", "gy", r6("red"), r6("nir"))


@register("band_pyramid_metadata", with_ctes(
    f"""select 'landsat' as layer, zoom::integer as zoom, 8 as tile_size, 'float64' as cell_type, min(gx // 8) as col_min, max(gx // 8) as col_max,
               count(distinct struct_pack(i := instant, c := gx // 8, r := gy // 8)) as cells, 'lonlat' as crs,
               -100.0::double + (max(gx // 8) + 1) * 0.25::double * (1 << ({PYRAMID_ZOOM} - zoom)) as x_max
        from levels group by zoom""", "landsat", extra=[_LEVELS]))
def q_band_pyramid_metadata(spark, sf):
    """One metadata row per level of the written pyramid, with its CRS and extent."""
    meta = cat.read_meta(spark, _band_pyramid(spark, sf))
    return meta.select("layer", F.col("zoom").cast("int").alias("zoom"), "tile_size", "cell_type", "col_min", "col_max", "cells", "crs", "x_max")


@register("scene_csv_scan", with_ctes(
    r"select time, scene_id, cast(regexp_extract(path, '_B(\d+)\.TIF', 1) as integer) as band, path from scenes",
    "scenes"))
def q_scene_csv_scan(spark, sf):
    """Write the scene list as a quoted CSV with header, read it back with a
    schema and the scene time format (A3)."""
    path = shared_dir(spark, "scenes_csv")
    s = fx.scenes(spark, sf).select("time", "scene_id",
                                    F.regexp_extract("path", r"_B(\d+)\.TIF", 1).cast("int").alias("band"), "path")
    sc.write_scene_csv(s, path)
    return sc.read_scene_csv(spark, path)


@register("geojson_polygons", with_ctes("select poly_id, x1, y1, x2, y2 from footprint_edges", "scenes",
                                        extra=[FOOTPRINTS]))
def q_geojson_polygons(spark, sf):
    """Scene footprints written as GeoJSON FeatureCollections and parsed back
    into edge tables (A4)."""
    path = shared_dir(spark, "geojson")
    # Ring = the 4 corners in edge order, closed (first point repeated).
    lon, lat = F.col("lon10") / F.lit(10.0), F.col("lat10") / F.lit(10.0)
    s = F.lit(2.0)
    ring = F.array(F.array(lon, lat), F.array(lon + s, lat), F.array(lon + s, lat + s), F.array(lon, lat + s),
                   F.array(lon, lat))
    rings = fx.scenes(spark, sf).select(F.col("scene_id").alias("poly_id"), ring.alias("ring"))
    sc.write_geojson(rings, path)
    return sc.read_geojson_polygons(spark, path)


@register("stream_ingest", with_ctes("select * from landsat", "landsat"))
def q_stream_ingest(spark, sf):
    """Incremental ingest as a stream: yearly drops of imagery cells arrive
    as files, each micro-batch is upserted into the catalog layer through
    ``foreachBatch`` (exactly-once batch boundaries via the checkpoint)."""
    from gridsmith.streaming.ingest import upsert_stream
    src = shared_dir(spark, "stream-src")
    l = fx.landsat(spark, sf)
    l.withColumn("drop", F.year("instant")).write.partitionBy("drop").parquet(src)
    from pyspark.sql.types import IntegerType, StructType
    schema = StructType(list(l.schema.fields)).add("drop", IntegerType())
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", 8).parquet(src).drop("drop"))
    root = shared_dir(spark, "stream-catalog")
    q = upsert_stream(stream, root, "landsat", ZOOM, fx.TILE, ["instant", "gx", "gy"],
                      shared_dir(spark, "stream-ckpt"), "uint16", 0)
    q.awaitTermination()
    return cat.read_layer(spark, root, "landsat", ZOOM).select(*LANDSAT_COLS)


@register("tile_layer_write_read", ORACLE["cells_to_tiles"])
def q_tile_layer_write_read(spark, sf):
    """The storage form: a tile-grain layer written Z-ordered and read back."""
    root = shared_dir(spark, "catalog")
    cat.write_layer(fx.dem_tiles(spark, sf), root, "dem", 5, fx.TILE, "int32", None)
    return cat.read_layer(spark, root, "dem", 5).select("col", "row", "cells")


@register("tile_layer_query", with_ctes(
    f"""select t.* from ({_dense_dem_sql}) t
        where (t.col, t.row) in (select (col, row) from touched where poly_id = {Q_POLY})""",
    "dem", "aoi_edges", extra=[touched_cte("dem")]))
def q_tile_layer_query(spark, sf):
    """Whole tiles of a tile-grain layer that intersect a polygon: key-range
    literals reach the Parquet scan, the exact test is a bounded semi join."""
    root = shared_dir(spark, "catalog")
    cat.write_layer(fx.dem_tiles(spark, sf), root, "dem", 5, fx.TILE, "int32", None)
    edges = fx.aoi_edges(spark).where(F.col("poly_id") == Q_POLY)
    return cat.query_layer(spark, root, "dem", 5, fx.TILE, edges).select("col", "row", "cells")
