"""Results do not depend on partitioning or on AQE."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import rows_of
from tests.conftest import SF_SMALL

KEYS = ["mask_polygon", "crop_histogram", "mosaic_bright", "mosaic_greenest", "mean_series", "zonal_mean",
        "stack_bands", "hillshade", "hillshade_tiles", "pyramid_bilinear", "reproject_bilinear", "cells_to_tiles",
        "tile_halo", "render_composite_ndvi", "crop_masked_ndvi_series", "ndvi_series_tiles", "union_batches",
        "zonal_mean_tiles", "mosaic_bright_tiles", "pyramid_bilinear_tiles", "mask_polygon_tiles"]


@pytest.mark.parametrize("key", KEYS)
def test_same_result_with_other_partitioning(spark, key):
    fn = E.queries()[key]
    base = fn(spark, SF_SMALL)
    want = rows_of(base.columns, [tuple(r) for r in base.collect()])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force shuffle joins where not hinted
        other = fn(spark, SF_SMALL)
        got = rows_of(other.columns, [tuple(r) for r in other.collect()])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
