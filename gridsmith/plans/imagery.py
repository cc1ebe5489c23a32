"""Imagery layer (F1): band math, cloud masking, joins with the class layer,
polygon statistics and the crop-masked NDVI time series (flagship)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridsmith.functions import indices as ix
from gridsmith.functions.grid import ntz, tile_of
from gridsmith.operators import polygon, zonal
from gridsmith.plans.oracle import inside_cte, with_ctes
from gridsmith.plans.registry import r6, register
from gridsmith.plans.sizing import broadcast_if_bounded
from gridsmith.sources import fixtures as fx

TARGET_CLASS = 24
TIME_FROM, TIME_TO = dt.datetime(1998, 4, 1), dt.datetime(1999, 9, 30)
SLICE_AT = dt.datetime(1998, 7, 1)

MASKED = """masked as (select instant, gx, gy,
  case when qa >> 14 = 3 then 0 else blue end as blue, case when qa >> 14 = 3 then 0 else green end as green,
  case when qa >> 14 = 3 then 0 else red end as red, case when qa >> 14 = 3 then 0 else nir end as nir from landsat)"""
NDVI = """ndvi_cells as (select instant, gx, gy,
  (nir::double - red::double) / nullif(nir::double + red::double, 0) as ndvi from masked)"""


def landsat(spark, sf):
    return fx.landsat(spark, sf)


def ndvi_cells(spark, sf):
    """``(instant, gx, gy, ndvi)`` after cloud masking; clouds give NULL."""
    l = landsat(spark, sf)
    return l.select("instant", "gx", "gy", ix.cloud_masked_index(l, "ndvi").alias("ndvi"))


@register("select_band", with_ctes("select instant, gx, gy, red from landsat", "landsat"))
def q_select_band(spark, sf):
    return landsat(spark, sf).select("instant", "gx", "gy", F.col(ix.BAND_COLUMNS[ix.BANDS["Red"]]))


@register("convert_cell_type", with_ctes(
    "select instant, gx, gy, case when red <> 0 then red::double end as red from masked", "landsat",
    extra=[MASKED]))
def q_convert_cell_type(spark, sf):
    m = ix.cloud_masked_bands(landsat(spark, sf))
    return m.select("instant", "gx", "gy", ix.to_float("red", 0).alias("red"))


@register("cloud_mask", with_ctes("select * from masked", "landsat", extra=[MASKED]))
def q_cloud_mask(spark, sf):
    return ix.cloud_masked_bands(landsat(spark, sf))


@register("map_algebra", with_ctes(
    """select instant, gx, gy, red + 10 as a, round(red + red * 0.1::double, 6) as b,
              round((green::double - nir::double) / nullif(green::double + nir::double, 0), 6) as c
       from landsat""", "landsat"))
def q_map_algebra(spark, sf):
    r, g, n = F.col("red"), F.col("green"), F.col("nir")
    return landsat(spark, sf).select("instant", "gx", "gy", (r + 10).alias("a"), r6(r + r * F.lit(0.1), "b"),
                                     r6(ix.normalized_difference(g, n), "c"))


@register("ndvi", with_ctes(
    "select instant, gx, gy, round((nir::double - red::double) / nullif(nir::double + red::double, 0), 6) as ndvi from landsat",
    "landsat"))
def q_ndvi(spark, sf):
    return landsat(spark, sf).select("instant", "gx", "gy", r6(ix.ndvi("red", "nir"), "ndvi"))


@register("ndwi", with_ctes(
    "select instant, gx, gy, round((green::double - nir::double) / nullif(green::double + nir::double, 0), 6) as ndwi from landsat",
    "landsat"))
def q_ndwi(spark, sf):
    return landsat(spark, sf).select("instant", "gx", "gy", r6(ix.ndwi("green", "nir"), "ndwi"))


@register("ndvi_safe", with_ctes(
    "select instant, gx, gy, round(coalesce(ndvi, 0), 6) as ndvi from ndvi_cells", "landsat",
    extra=[MASKED, NDVI]))
def q_ndvi_safe(spark, sf):
    m = ix.cloud_masked_bands(landsat(spark, sf))
    return m.select("instant", "gx", "gy", r6(ix.ndvi_safe("red", "nir"), "ndvi"))


@register("cloud_masked_ndvi", with_ctes(
    "select instant, gx, gy, round(ndvi, 6) as ndvi from ndvi_cells", "landsat", extra=[MASKED, NDVI]))
def q_cloud_masked_ndvi(spark, sf):
    return ndvi_cells(spark, sf).select("instant", "gx", "gy", r6("ndvi"))


@register("cloud_masked_ndwi", with_ctes(
    """select instant, gx, gy, round((green::double - nir::double) / nullif(green::double + nir::double, 0), 6) as ndwi
       from masked""", "landsat", extra=[MASKED]))
def q_cloud_masked_ndwi(spark, sf):
    l = landsat(spark, sf)
    return l.select("instant", "gx", "gy", r6(ix.cloud_masked_index(l, "ndwi"), "ndwi"))


@register("rekey_spatial", with_ctes(
    "select gx // 8 as col, gy // 8 as row, gx, gy, instant, red, nir from landsat", "landsat"))
def q_rekey_spatial(spark, sf):
    """Space-time key -> spatial key; the instant travels in the value."""
    l = landsat(spark, sf)
    return l.select(tile_of("gx", fx.TILE).alias("col"), tile_of("gy", fx.TILE).alias("row"),
                    "gx", "gy", "instant", "red", "nir")


@register("filter_time_range", with_ctes(
    f"select * from landsat where instant between '{TIME_FROM}' and '{TIME_TO}'", "landsat"))
def q_filter_time_range(spark, sf):
    return landsat(spark, sf).where(F.col("instant").between(ntz(TIME_FROM), ntz(TIME_TO)))


@register("slice_at_time", with_ctes(
    f"select gx, gy, blue, green, red, nir, qa from landsat where instant = '{SLICE_AT}'", "landsat"))
def q_slice_at_time(spark, sf):
    from gridsmith.operators.mosaic import slice_at_time
    return slice_at_time(landsat(spark, sf), SLICE_AT)


@register("join_spacetime_spatial", with_ctes(
    "select l.instant, gx, gy, l.red, l.nir, c.value, c.nlcd from landsat l join classes c using (gx, gy)",
    "landsat", "classes"))
def q_join_spacetime_spatial(spark, sf):
    """Each date of a pixel meets the one static class cell (C1).  An equi-join
    on the pixel key: shuffle-hash/sort-merge at scale, AQE may broadcast the
    static side when its measured size is small."""
    l = landsat(spark, sf).select("instant", "gx", "gy", "red", "nir")
    return l.join(fx.classes(spark, sf), ["gx", "gy"], "inner")


@register("layer_binary_op", with_ctes(
    "select l.instant, gx, gy, l.nir - c.value * 10 as v from landsat l join classes c using (gx, gy)",
    "landsat", "classes"))
def q_layer_binary_op(spark, sf):
    """Layer-layer map algebra on the full key."""
    l = landsat(spark, sf).select("instant", "gx", "gy", "nir")
    c = fx.classes(spark, sf).select("gx", "gy", "value")
    return l.join(c, ["gx", "gy"]).select("instant", "gx", "gy", (F.col("nir") - F.col("value") * 10).alias("v"))


def crop_masked_ndvi(spark, sf, target: int = TARGET_CLASS):
    """NDVI where the crop layer has ``target``, NULL elsewhere."""
    c = fx.classes(spark, sf).select("gx", "gy", "value")
    j = ndvi_cells(spark, sf).join(c, ["gx", "gy"])
    return j.select("instant", "gx", "gy", F.when(F.col("value") == target, F.col("ndvi")).alias("ndvi"))


@register("mask_by_layer", with_ctes(
    f"""select n.instant, gx, gy, round(case when c.value = {TARGET_CLASS} then n.ndvi end, 6) as ndvi
        from ndvi_cells n join classes c using (gx, gy)""", "landsat", "classes", extra=[MASKED, NDVI]))
def q_mask_by_layer(spark, sf):
    return crop_masked_ndvi(spark, sf).select("instant", "gx", "gy", r6("ndvi"))


@register("min_max", with_ctes(
    "select round(min(ndvi), 6) as min, round(max(ndvi), 6) as max from ndvi_cells", "landsat",
    extra=[MASKED, NDVI]))
def q_min_max(spark, sf):
    mm = zonal.min_max(ndvi_cells(spark, sf), "ndvi")
    return mm.select(r6("min"), r6("max"))


@register("mean_series", with_ctes(
    """select instant, round(avg(ndvi), 6) as mean, count(ndvi) as n from ndvi_cells
       where (gx, gy) in (select gx, gy from inside) group by instant""",
    "landsat", "aoi_edges", extra=[MASKED, NDVI, inside_cte("landsat")]))
def q_mean_series(spark, sf):
    cells = polygon.mask_polygon(ndvi_cells(spark, sf), fx.aoi_edges(spark))
    s = zonal.mean_series(cells, "ndvi")
    return s.select("instant", r6("mean"), "n")


@register("zonal_mean", with_ctes(
    """select i.poly_id, n.instant, round(avg(n.ndvi), 6) as mean, count(n.ndvi) as n
       from ndvi_cells n join inside i using (gx, gy) group by i.poly_id, n.instant""",
    "landsat", "aoi_edges", extra=[MASKED, NDVI, inside_cte("landsat")]))
def q_zonal_mean(spark, sf):
    """Mean NDVI per polygon and instant (C9, multi-polygon form)."""
    cells = polygon.cells_in_polygons(ndvi_cells(spark, sf), fx.aoi_edges(spark))
    s = zonal.mean_series(cells, "ndvi", by=("poly_id", "instant"))
    return s.select("poly_id", "instant", r6("mean"), "n")


def crop_series_raw(spark, sf):
    cells = polygon.mask_polygon(crop_masked_ndvi(spark, sf), fx.aoi_edges(spark))
    return zonal.mean_series(cells, "ndvi")


def crop_masked_ndvi_series(spark, sf, target: int = TARGET_CLASS):
    """Flagship: cloud mask -> NDVI -> keep pixels of one crop class inside
    the polygons -> mean per instant -> drop missing -> noise cut.

    Plan shape for scale: the static class layer is filtered first (one
    class, polygon semi join against broadcast row spans), and the big
    space-time layer is then semi-joined to that pixel set — broadcast when
    the polygons' pixel bound proves it small, a shuffle join otherwise — so the imagery is
    scanned once and never shuffled for the join; the mean is a partial
    aggregate per instant.  Equal to masking after the join: instants whose
    mean is missing are dropped either way."""
    edges = fx.aoi_edges(spark)
    crop = fx.classes(spark, sf).where(F.col("value") == target).select("gx", "gy")
    crop = polygon.mask_polygon(crop, edges)
    # The class layer has one row per pixel, so the masked pixel set is
    # bounded by the polygons' bounding-box area: broadcast on that proof,
    # without a counting pass over the layer; beyond it, a shuffle join.
    cells = ndvi_cells(spark, sf).join(broadcast_if_bounded(crop, polygon.pixel_bound(edges)), ["gx", "gy"], "left_semi")
    s = zonal.series_threshold(zonal.series_dropna(zonal.mean_series(cells, "ndvi")))
    return s.select("instant", r6("mean"), "n")


SERIES = f"""series as (
  select instant, avg(v) as mean, count(v) as n from (
    select n.instant, case when c.value = {TARGET_CLASS} then n.ndvi end as v
    from ndvi_cells n join classes c using (gx, gy)
    where (n.gx, n.gy) in (select gx, gy from inside)) t
  group by instant)"""
SERIES_CTES = ("landsat", "classes", "aoi_edges")
SERIES_EXTRA = [MASKED, NDVI, inside_cte("landsat"), SERIES]


@register("crop_masked_ndvi_series", with_ctes(
    "select instant, round(mean, 6) as mean, n from series where mean is not null and abs(mean) > 0.001",
    *SERIES_CTES, extra=SERIES_EXTRA))
def q_crop_masked_ndvi_series(spark, sf):
    return crop_masked_ndvi_series(spark, sf)


@register("series_dropna", with_ctes(
    "select instant, round(mean, 6) as mean, n from series where mean is not null", *SERIES_CTES, extra=SERIES_EXTRA))
def q_series_dropna(spark, sf):
    return zonal.series_dropna(crop_series_raw(spark, sf)).select("instant", r6("mean"), "n")


@register("series_threshold", with_ctes(
    "select instant, round(mean, 6) as mean, n from series where abs(mean) > 0.001", *SERIES_CTES, extra=SERIES_EXTRA))
def q_series_threshold(spark, sf):
    return zonal.series_threshold(crop_series_raw(spark, sf)).select("instant", r6("mean"), "n")


@register("series_nullif_zero", with_ctes(
    "select instant, round(mean, 6) as mean, n from series where nullif(mean, 0) is not null and abs(mean) > 0.001",
    *SERIES_CTES, extra=SERIES_EXTRA))
def q_series_nullif_zero(spark, sf):
    return zonal.series_nullif_zero(crop_series_raw(spark, sf)).select("instant", r6("mean"), "n")


@register("argmax_time", with_ctes(
    """select arg_min(instant, (-mean, instant)) as instant, round(max(mean), 6) as mean
       from series where mean is not null""", *SERIES_CTES, extra=SERIES_EXTRA))
def q_argmax_time(spark, sf):
    a = zonal.argmax_time(crop_series_raw(spark, sf), "mean")
    return a.select("instant", r6("mean"))
