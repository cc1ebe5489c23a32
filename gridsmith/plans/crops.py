"""Crop / land-cover class layer (F2): the histogram notebook and friends."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsmith.operators import polygon, zonal
from gridsmith.plans.oracle import inside_cte, with_ctes
from gridsmith.plans.registry import register
from gridsmith.plans.sizing import broadcast_if_small
from gridsmith.sources import fixtures as fx

TARGET_CLASS = 24  # the class kept by the single-class mask


def _classes(spark, sf):
    return fx.classes(spark, sf)


@register("mask_polygon", with_ctes(
    "select gx, gy, value, nlcd from classes where (gx, gy) in (select gx, gy from inside)",
    "classes", "aoi_edges", extra=[inside_cte("classes")]))
def q_mask_polygon(spark, sf):
    return polygon.mask_polygon(_classes(spark, sf), fx.aoi_edges(spark))


@register("class_histogram", with_ctes(
    "select value, count(*) as cells from classes where value <> 0 group by value", "classes"))
def q_class_histogram(spark, sf):
    return zonal.class_histogram(_classes(spark, sf), "value", 0)


@register("merge_counts", with_ctes(
    """select value, cast(sum(cells) as bigint) as cells from (
         select value, count(*) as cells from classes where value <> 0 group by value
         union all
         select nlcd as value, count(*) as cells from classes where nlcd <> 0 group by nlcd) t
       group by value""", "classes"))
def q_merge_counts(spark, sf):
    # One layer, two count maps: both branches read the same columns so the
    # layer's exchange is computed once and reused.
    c = _classes(spark, sf).select("gx", "gy", "value", "nlcd")
    return zonal.merge_counts(zonal.class_histogram(c, "value", 0), zonal.class_histogram(c, "nlcd", 0))


@register("drop_nodata", with_ctes("select gx, gy, value from classes where value <> 0", "classes"))
def q_drop_nodata(spark, sf):
    return zonal.drop_nodata(_classes(spark, sf).select("gx", "gy", "value"), "value", 0)


@register("class_whitelist", with_ctes(
    "select gx, gy, value from classes where value in (select code from crop_labels where is_crop)",
    "classes", "crop_labels"))
def q_class_whitelist(spark, sf):
    allowed = fx.crop_labels(spark).where("is_crop")
    return zonal.class_whitelist(_classes(spark, sf).select("gx", "gy", "value"), allowed)


@register("mask_by_value", with_ctes(
    f"select gx, gy, case when value = {TARGET_CLASS} then value end as value from classes", "classes"))
def q_mask_by_value(spark, sf):
    c = _classes(spark, sf)
    return c.select("gx", "gy", F.when(F.col("value") == TARGET_CLASS, F.col("value")).alias("value"))


@register("label_lookup", with_ctes(
    """select h.value, h.cells, l.name, l.is_crop, l.rgba
       from (select value, count(*) as cells from classes where value <> 0 group by value) h
       left join crop_labels l on l.code = h.value""", "classes", "crop_labels"))
def q_label_lookup(spark, sf):
    h = zonal.class_histogram(_classes(spark, sf), "value", 0)
    return zonal.label_lookup(h, fx.crop_labels(spark))


@register("label_to_code", with_ctes(
    """select l.name, max(l.code) as code, cast(sum(h.cells) as bigint) as cells
       from (select value, count(*) as cells from classes where value <> 0 group by value) h
       join crop_labels l on l.code = h.value group by l.name""", "classes", "crop_labels"))
def q_label_to_code(spark, sf):
    """Counts per label name, each name mapped back to one code (last wins)."""
    h = zonal.class_histogram(_classes(spark, sf), "value", 0)
    labels = fx.crop_labels(spark).select(F.col("code").alias("value"), "name")
    named = h.join(broadcast_if_small(labels), "value").withColumnRenamed("value", "code")
    return zonal.label_to_code(named, F.sum("cells").alias("cells")).select("name", "code", "cells")


def crop_histogram(spark, sf):
    """The histogram notebook end to end: mask by polygons, count classes,
    label them, keep crop classes."""
    masked = polygon.mask_polygon(_classes(spark, sf), fx.aoi_edges(spark))
    h = zonal.class_histogram(masked, "value", 0)
    return zonal.label_lookup(h, fx.crop_labels(spark)).where("is_crop").select("value", "name", "cells")


@register("crop_histogram", with_ctes(
    """select h.value, l.name, h.cells
       from (select value, count(*) as cells from classes
             where value <> 0 and (gx, gy) in (select gx, gy from inside) group by value) h
       join crop_labels l on l.code = h.value where l.is_crop""",
    "classes", "aoi_edges", "crop_labels", extra=[inside_cte("classes")]))
def q_crop_histogram(spark, sf):
    return crop_histogram(spark, sf)


@register("top_crops", with_ctes(
    """select h.value, l.name, h.cells
       from (select value, count(*) as cells from classes
             where value <> 0 and (gx, gy) in (select gx, gy from inside) group by value) h
       join crop_labels l on l.code = h.value where l.is_crop
       order by h.cells desc, h.value limit 3""",
    "classes", "aoi_edges", "crop_labels", extra=[inside_cte("classes")]))
def q_top_crops(spark, sf):
    return zonal.top_classes(crop_histogram(spark, sf), 3)


@register("distinct_values", with_ctes(
    "select elev as value, count(*) as cells from dem group by elev", "dem"))
def q_distinct_values(spark, sf):
    return zonal.distinct_values(fx.dem(spark, sf), "elev")


@register("force_cell_type", with_ctes(
    "select gx, gy, cast(least(greatest(value * 7, 0), 255) as integer) as value from classes", "classes"))
def q_force_cell_type(spark, sf):
    """Force uint8 (clip to 0..255) after a scaling that overflows it."""
    from gridsmith.functions.cells import force_cell_type
    c = _classes(spark, sf)
    return c.select("gx", "gy", force_cell_type(F.col("value") * 7, "uint8").alias("value"))


@register("polygon_bounds", with_ctes(
    """select poly_id, least(min(x1), min(x2)) as xmin, least(min(y1), min(y2)) as ymin,
              greatest(max(x1), max(x2)) as xmax, greatest(max(y1), max(y2)) as ymax
       from footprint_edges group by poly_id""", "scenes",
    extra=["""footprint_edges as (
       select scene_id as poly_id, a + dx1 * 2.0 as x1, b + dy1 * 2.0 as y1, a + dx2 * 2.0 as x2, b + dy2 * 2.0 as y2
       from (select scene_id, lon10 / 10.0::double as a, lat10 / 10.0::double as b from scenes) s,
            (values (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)) r(dx1, dy1, dx2, dy2))"""]))
def q_polygon_bounds(spark, sf):
    from gridsmith.operators.geometry import footprint_edges
    return polygon.polygon_bounds(footprint_edges(fx.scenes(spark, sf)))


NLCD_SQL = "nlcd_labels as (select code::integer as code, name from (values " + ", ".join(
    "(%d, '%s')" % (c, n) for c, n in fx.NLCD_LABELS) + ") t(code, name))"


@register("nlcd_histogram", with_ctes(
    f"""select h.value, l.name, h.cells
        from (select nlcd as value, count(*) as cells from classes
              where nlcd <> {fx.NLCD_NODATA} and (gx, gy) in (select gx, gy from inside) group by nlcd) h
        left join nlcd_labels l on l.code = h.value""",
    "classes", "aoi_edges", extra=[inside_cte("classes"), NLCD_SQL]))
def q_nlcd_histogram(spark, sf):
    """Land-cover notebook: mask by the polygons, count classes (NoData -128
    dropped, code 0 kept), attach the land-cover labels."""
    masked = polygon.mask_polygon(_classes(spark, sf).select("gx", "gy", "nlcd"), fx.aoi_edges(spark))
    h = zonal.class_histogram(masked, "nlcd", fx.NLCD_NODATA)
    return zonal.label_lookup(h, fx.nlcd_labels(spark)).select("value", "name", "cells")
