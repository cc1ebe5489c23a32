"""

    from gridsmith import api as gs
    cells = gs.layer_query(spark, catalog, "landsat", 13, edges, (t0, t1), tile_size=256)
    series = gs.mean_series(gs.mask_polygon(cells.select(..., gs.ndvi("red", "nir").alias("ndvi")), edges), "ndvi")
"""

from gridsmith.functions.color import (  # noqa: F401
    alpha, colormap_exact, colormap_le, gamma, hsv_to_rgb_df, rgb_to_hsv, rgba_unpack, saturation, saturation_df,
    shade, sigmoidal, stretch,
)
from gridsmith.functions.grid import key_to_extent, morton2, morton3, ntz, padded_index, tile_of, window_extent  # noqa: F401
from gridsmith.functions.indices import (  # noqa: F401
    cloud_mask, cloud_masked_bands, cloud_masked_index, is_cloud, ndvi, ndvi_safe, ndwi, normalized_difference,
    nodata_to_null, to_float,
)
from gridsmith.operators.focal import (  # noqa: F401
    hillshade, horn_gradients, neighbourhood, pyramid, reproject_lonlat_to_mercator, tile_halo,
)
from gridsmith.operators.geometry import footprint_edges, lonlat_to_mercator, mercator_to_lonlat, ring_to_edges  # noqa: F401
from gridsmith.operators.ingest import (  # noqa: F401
    array_shape_check, band_whitelist, buffer_windows, complete_band_sets, first_match, list_windows, result_page, search_scenes,
    shape_check, split_uri, stack_bands, stack_bands_pivot,
)
from gridsmith.operators.mosaic import collapse_time, mosaic, slice_at_time, tile_merge  # noqa: F401
from gridsmith.operators.polygon import (  # noqa: F401
    cells_in_polygons, extents_within, mask_polygon, polygon_bounds, polygon_centroid, row_spans, tiles_intersecting,
    tiles_touched,
)
from gridsmith.operators.band_pyramid import band_pyramid, write_pyramid  # noqa: F401
from gridsmith.operators.rasters import (  # noqa: F401
    Grid, mosaic_tiles, overlay_tiles, read_windows, reproject_tiles, reproject_windows, retile, stack_windows, to_layout,
    window_side, windows_to_lines,
)
from gridsmith.operators.render import composite_join, near_cells, render3, render4, render_with_hillshade  # noqa: F401
from gridsmith.operators.tile_map import map_tiles  # noqa: F401
from gridsmith.operators.tiles import cells_to_band_tiles, cells_to_tiles, extent_to_keys, tiles_to_cells  # noqa: F401
from gridsmith.operators.zonal import (  # noqa: F401
    argmax_time, class_histogram, class_whitelist, distinct_values, drop_nodata, label_lookup, label_to_code,
    mean_series, merge_counts, min_max, series_dropna, series_nullif_zero, series_threshold, top_classes,
)
from gridsmith.sources.bucketed import join_static as join_bucketed, write_series, write_static  # noqa: F401
from gridsmith.sources.catalog import (  # noqa: F401
    drop_old_versions, layer_exists, layer_meta, merge_meta, query_layer as layer_query, read_layer, read_manifest, read_meta,
    upsert_layer, write_layer,
)
from gridsmith.sources.scenes import read_geojson_polygons, read_scene_csv  # noqa: F401
from gridsmith.streaming.ingest import upsert_stream  # noqa: F401
from gridsmith.operators import tile_grain as tiles_fast  # noqa: F401


def join_static(series_cells, static_cells, keys=("gx", "gy")):
    """Space-time cells x static cells on the pixel key."""
    return series_cells.join(static_cells, list(keys), "inner")
