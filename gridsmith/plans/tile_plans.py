"""Tile-grain fast paths, checked against the same oracles as the cell path."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsmith.operators import tile_grain as tg
from gridsmith.operators import tiles as tl
from gridsmith.operators import zonal
from gridsmith.plans.focal_plans import ALTITUDE, AZIMUTH, CELL_SIZE, DEM_LEVELS, DEM_ZOOM, Z_FACTOR
from gridsmith.plans.registry import ORACLE, r6, register
from gridsmith.plans.imagery import MASKED, NDVI
from gridsmith.plans.oracle import inside_cte, with_ctes
from gridsmith.sources import fixtures as fx


@register("class_histogram_tiles", ORACLE["class_histogram"])
def q_class_histogram_tiles(spark, sf):
    tiles = tl.cells_to_tiles(fx.classes(spark, sf), fx.TILE, value="value")
    h = tg.class_counts(tiles, nodata=0)
    return h.select(F.col("value").cast("int").alias("value"), "cells")


@register("distinct_values_tiles", ORACLE["distinct_values"])
def q_distinct_values_tiles(spark, sf):
    return tg.class_counts(fx.dem_tiles(spark, sf), drop_nodata=False)


@register("hillshade_tiles", ORACLE["hillshade"])
def q_hillshade_tiles(spark, sf):
    hs = tg.hillshade(fx.dem_tiles(spark, sf), fx.TILE, AZIMUTH, ALTITUDE, Z_FACTOR, CELL_SIZE)
    cells = tl.tiles_to_cells(hs, fx.TILE, cells="hillshade", value="hillshade")
    return cells.select("gx", "gy", r6("hillshade"))


@register("ndvi_series_tiles", with_ctes(
    "select instant, round(avg(ndvi), 6) as mean, count(ndvi) as n from ndvi_cells group by instant",
    "landsat", extra=[MASKED, NDVI]))
def q_ndvi_series_tiles(spark, sf):
    tiles = tl.cells_to_band_tiles(fx.landsat(spark, sf), fx.TILE, ["red", "nir", "qa"], extra=("instant",))
    s = tg.ndvi_series(tiles)
    return s.select("instant", r6("mean"), "n")


@register("mask_polygon_tiles", with_ctes(
    "select gx, gy, value from classes where (gx, gy) in (select gx, gy from inside)",
    "classes", "aoi_edges", extra=[inside_cte("classes")]))
def q_mask_polygon_tiles(spark, sf):
    tiles = tl.cells_to_tiles(fx.classes(spark, sf), fx.TILE, value="value")
    masked = tg.mask_polygon(tiles, fx.aoi_edges(spark), fx.TILE)
    return tl.tiles_to_cells(masked, fx.TILE, value="value")


@register("crop_histogram_tiles", ORACLE["crop_histogram"])
def q_crop_histogram_tiles(spark, sf):
    """The histogram notebook at tile grain: mask tiles, count classes in
    numpy, label, keep crops."""
    tiles = tl.cells_to_tiles(fx.classes(spark, sf), fx.TILE, value="value")
    masked = tg.mask_polygon(tiles, fx.aoi_edges(spark), fx.TILE)
    h = tg.class_counts(masked, nodata=0).select(F.col("value").cast("int").alias("value"), "cells")
    return zonal.label_lookup(h, fx.crop_labels(spark)).where("is_crop").select("value", "name", "cells")


@register("pyramid_bilinear_tiles", ORACLE["pyramid_bilinear"])
def q_pyramid_bilinear_tiles(spark, sf):
    p = tg.pyramid(fx.dem_tiles(spark, sf), fx.TILE, DEM_ZOOM, DEM_ZOOM - DEM_LEVELS, "bilinear")
    cells = tl.tiles_to_cells(p, fx.TILE, value="value", extra=("zoom",))
    return cells.select("zoom", "gx", "gy", r6("value"))


@register("mean_series_tiles", ORACLE["mean_series"])
def q_mean_series_tiles(spark, sf):
    """Polygon mean NDVI per instant entirely at tile grain: band tiles,
    tile polygon mask, per-tile (sum, count) partials."""
    tiles = tl.cells_to_band_tiles(fx.landsat(spark, sf), fx.TILE, ["red", "nir", "qa"], extra=("instant",))
    masked = tg.mask_polygon(tiles, fx.aoi_edges(spark), fx.TILE, ["red", "nir", "qa"])
    s = tg.ndvi_series(masked)
    return s.select("instant", r6("mean"), "n")


@register("pyramid_nearest_tiles", ORACLE["pyramid_nearest"])
def q_pyramid_nearest_tiles(spark, sf):
    """Class-layer pyramid at tile grain: nearest rule, NoData children count."""
    tiles = tl.cells_to_tiles(fx.classes(spark, sf), fx.TILE, value="value")
    p = tg.pyramid(tiles, fx.TILE, 2, 0, "nearest")
    cells = tl.tiles_to_cells(p, fx.TILE, value="value", extra=("zoom",))
    return cells.select("zoom", "gx", "gy", F.col("value").cast("int").alias("value"))


@register("mosaic_bright_tiles", ORACLE["mosaic_bright"])
def q_mosaic_bright_tiles(spark, sf):
    """Mosaic of a tile-grain imagery layer: the per-pixel choice is a
    partial ``max_by`` (never a per-tile stack of all dates), the result is
    gathered back into band tiles (bounded groups) and read out as cells."""
    from gridsmith.functions.indices import cloud_masked_bands
    from gridsmith.operators import mosaic as mo
    bands = ["blue", "green", "red", "nir"]
    stored = tl.cells_to_band_tiles(fx.landsat(spark, sf), fx.TILE, bands + ["qa"], extra=("instant",))
    cells = tl.band_tiles_to_cells(stored, fx.TILE, bands + ["qa"], extra=("instant",))
    composite = tl.cells_to_band_tiles(mo.mosaic(cloud_masked_bands(cells), "bright"), fx.TILE, bands)
    return tl.band_tiles_to_cells(composite, fx.TILE, bands)


@register("zonal_mean_tiles", ORACLE["zonal_mean"])
def q_zonal_mean_tiles(spark, sf):
    """Mean NDVI per polygon and instant at tile grain (C9 fast path)."""
    tiles = tl.cells_to_band_tiles(fx.landsat(spark, sf), fx.TILE, ["red", "nir", "qa"], extra=("instant",))
    masked = tg.mask_polygon(tiles, fx.aoi_edges(spark), fx.TILE, ["red", "nir", "qa"], by_polygon=True)
    s = tg.ndvi_series(masked, by=("poly_id", "instant"))
    return s.select("poly_id", "instant", r6("mean"), "n")
