"""Scene-list ingest: scene filters, window listing, band stacking.

The reference loops over weekday groups on the driver and groups band
windows with ``groupByKey``; here each step is one DataFrame stage: window
lists are generated row-locally (``explode(sequence)``), band sets are
checked with a partial-aggregated count and stacked with bounded groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Landsat 8 band names (band number = position + 1) and the
# bands the composite ingest keeps, name -> index.
LANDSAT8_BAND_NAMES = [
    "coastal aerosol - 1", "blue - 2", "green - 3", "red - 4", "near infrared - 5", "swir - 6", "swir - 7",
    "panchromatic - 8", "cirrus - 9", "thermal infrared - 10", "thermal infrared - 11",
]
DESIRED_BANDS = {"blue - 2": 1, "green - 3": 2, "red - 4": 3, "near infrared - 5": 4}
WINDOW = 512   # source window size (cells)
HALO = 3       # extra cells read around a window for reprojection


def band_name(band: Column) -> Column:
    names = F.array(*[F.lit(n) for n in LANDSAT8_BAND_NAMES])
    return F.try_element_at(names, band.cast("int"))  # NULL beyond the list


def desired_bands(spark) -> DataFrame:
    return spark.createDataFrame(list(DESIRED_BANDS.items()), "band_name string, band_num int")


def band_whitelist(rows: DataFrame, lookup: DataFrame, name_col: str = "band_name") -> DataFrame:
    """Keep rows whose band name is wanted and attach its index.
    The band list is broadcast after a size check.  A wanted index of 0 is
    kept (null test, not truthiness)."""
    from gridsmith.plans.sizing import broadcast_if_small
    return rows.join(broadcast_if_small(lookup), name_col, "inner").where(F.col("band_num").isNotNull())


def complete_band_sets(rows: DataFrame, key: str = "scene", size: int = 5) -> DataFrame:
    """Rows of groups holding exactly ``size`` rows (B10).  The count is a
    partial aggregate; a hot group never gathers in one task, and the
    semi-join back is split by AQE skew handling if a key is hot."""
    full = rows.groupBy(key).count().where(F.col("count") == size).select(key)
    return rows.join(full, key, "left_semi")


def stack_bands(rows: DataFrame, key: str = "scene", band: str = "band", value: str = "v", size: int = 5) -> DataFrame:
    """Multiband stack per group, ordered by band (D8).  Only complete sets
    are stacked, so every collected group holds exactly ``size`` rows."""
    full = complete_band_sets(rows, key, size)
    g = full.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(band).alias("b"), F.col(value).alias("v")))).alias("s"))
    return g.select(key, F.col("s.b").alias("bands"), F.col("s.v").alias("values"))


def stack_bands_pivot(rows: DataFrame, key: str = "scene", band: str = "band", value: str = "v",
                      bands=(1, 2, 3, 4, 5)) -> DataFrame:
    """One column per band (D8 pivot form): conditional aggregates, fully
    partial-aggregated; a duplicated band keeps its largest value and a
    missing band is NULL."""
    full = complete_band_sets(rows, key, len(bands))
    return full.groupBy(key).agg(*[F.max(F.when(F.col(band) == b, F.col(value))).alias(f"b{b}") for b in bands])


def shape_check(rows: DataFrame, key: str = "scene", band: str = "band") -> DataFrame:
    """Groups whose stack would be ragged: duplicated band numbers."""
    g = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct(band).alias("n_bands"))
    return g.where(F.col("n_rows") != F.col("n_bands"))


def array_shape_check(rows: DataFrame, key: str = "scene", cells: str = "cells", width: str = "width") -> DataFrame:
    """``(key, n_rows, shapes)`` of the groups whose arrays cannot be stacked, as they differ in shape or are no whole
    lines (D9).  Shapes are ``width x height`` (a part of a line as a fraction), sorted; the set of a group's shapes is
    partially aggregated, so no array is shuffled."""
    lines = F.size(cells) / F.col(width)
    shape = F.concat_ws("x", F.col(width).cast("string"), F.when(lines == F.floor(lines), F.floor(lines).cast("string")).otherwise(
        lines.cast("string")))
    g = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.sort_array(F.collect_set(shape)).alias("shapes"),
                              F.max(F.size(cells) % F.col(width)).alias("_rest"))
    return g.where((F.size("shapes") > 1) | (F.col("_rest") > 0)).select(key, "n_rows", "shapes")


def list_windows(df: DataFrame, n_cols: str = "n_cols", n_rows: str = "n_rows", size: int = WINDOW,
                 keep=()) -> DataFrame:
    """All ``size`` windows of a raster, partial edge windows kept."""
    w = df.select(*keep, n_cols, n_rows,
                  F.explode(F.sequence(F.lit(0), F.col(n_cols) - 1, F.lit(size))).alias("col_off"))
    w = w.select(*keep, n_cols, n_rows, "col_off",
                 F.explode(F.sequence(F.lit(0), F.col(n_rows) - 1, F.lit(size))).alias("row_off"))
    return w.select(*keep, "col_off", "row_off",
                    F.least(F.lit(size), F.col(n_cols) - F.col("col_off")).alias("width"),
                    F.least(F.lit(size), F.col(n_rows) - F.col("row_off")).alias("height"),
                    n_cols, n_rows)


def buffer_windows(w: DataFrame, halo: int = HALO) -> DataFrame:
    """Grow each window by ``halo`` cells, clamped to the raster."""
    return w.select("*",
                    F.greatest(F.lit(0), F.col("col_off") - halo).alias("bcol0"),
                    F.greatest(F.lit(0), F.col("row_off") - halo).alias("brow0"),
                    F.least(F.col("n_cols") - 1, F.col("col_off") + F.col("width") - 1 + halo).alias("bcol1"),
                    F.least(F.col("n_rows") - 1, F.col("row_off") + F.col("height") - 1 + halo).alias("brow1"))


def split_uri(path: Column) -> tuple[Column, Column]:
    """``s3://bucket/key`` -> (bucket, key); a missing key is '' (H11)."""
    bucket = F.regexp_extract(path, r"^[a-zA-Z0-9]+://([^/]+)", 1)
    key = F.coalesce(F.regexp_extract(path, r"^[a-zA-Z0-9]+://[^/]+/(.*)$", 1), F.lit(""))
    return bucket, key


def epoch_millis_ntz(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ without any session-zone step."""
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86400000 + F.hour(ts) * 3600000
            + F.minute(ts) * 60000 + F.second(ts) * 1000)


def iso_weekday(ts: Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + 1


def search_scenes(scenes: DataFrame, time: Column | None = None, between=None, extent=None, box=None,
                  cloud: Column | None = None, max_cloud: float | None = None) -> DataFrame:
    """Scenes acquired ``between`` two instants (both included) whose ``extent`` (columns xmin, ymin, xmax, ymax) overlaps
    the ``box`` in more than a border and whose cloud cover is at most ``max_cloud`` (A6).  A criterion that is left
    out does not filter; scenes with a null there are kept only then.  All criteria reach the scan as one filter."""
    if between is not None:
        scenes = scenes.where(time.between(F.lit(between[0]).cast("timestamp_ntz"), F.lit(between[1]).cast("timestamp_ntz")))
    if max_cloud is not None:
        scenes = scenes.where(cloud <= F.lit(max_cloud))
    if box is not None:
        (x0, y0, x1, y1), (bx0, by0, bx1, by1) = extent, map(F.lit, box)
        scenes = scenes.where((x0 < bx1) & (x1 > bx0) & (y0 < by1) & (y1 > by0))
    return scenes


def result_page(rows: DataFrame, order: list[str], page: int, size: int) -> DataFrame:
    """Page number ``page`` (from 0) of ``size`` rows in the order of ``order``, which should name a key so that pages neither
    share nor lose rows (U4).  Pages are for showing results: a job works on all rows."""
    return rows.orderBy(*order).offset(page * size).limit(size)


def first_match(array: Column, predicate) -> Column:
    """First element of an array that meets the predicate, null if none does or the array is null or empty."""
    return F.get(F.filter(array, predicate), F.lit(0))
