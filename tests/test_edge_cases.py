"""Hand-made edge cases (FIXTURES.md §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridsmith.functions import color as co
from gridsmith.functions import indices as ix
from gridsmith.operators import focal, geometry, mosaic, polygon, zonal
from gridsmith.sources import fixtures as fx

T0, T1 = dt.datetime(2016, 6, 1), dt.datetime(2016, 7, 1)
PX = "gx long, gy long, instant timestamp_ntz, blue int, green int, red int, nir int, qa int"


def test_all_dates_cloudy(spark):
    rows = [(0, 0, T0, 7000, 7000, 7000, 8000, 53248), (0, 0, T1, 7000, 7000, 7000, 8000, 65535)]
    m = ix.cloud_masked_bands(spark.createDataFrame(rows, PX))
    r = mosaic.mosaic(m, "bright").collect()[0]
    assert (r.blue, r.green, r.red, r.nir) == (0, 0, 0, 0)  # newest pixel, all masked
    s = zonal.mean_series(m.select("instant", ix.ndvi("red", "nir").alias("v")), "v").collect()
    assert all(x.mean is None and x.n == 0 for x in s)
    assert zonal.series_dropna(zonal.mean_series(m.select("instant", ix.ndvi("red", "nir").alias("v")), "v")).count() == 0


def test_qa_zero_is_clear(spark):
    df = spark.createDataFrame([(0,), (65535,), (49152,), (16384,)], "qa int")
    assert [r.c for r in df.select(ix.is_cloud("qa").alias("c")).collect()] == [False, True, True, False]


def test_same_instant_tie_is_deterministic(spark):
    rows = [(0, 0, T0, 7000, 1, 1, 1, 0), (0, 0, T0, 8000, 1, 1, 1, 0), (0, 0, T0, 6500, 1, 1, 1, 0)]
    df = spark.createDataFrame(rows, PX)
    for n in (1, 3):
        assert mosaic.mosaic(df.repartition(n), "bright").collect()[0].blue == 8000


def test_centre_on_edge_half_open(spark):
    # Square 0..4 x 0..4: centres at x = 0.5..3.5 are inside; a vertical edge through
    # a centre (x = 2.5) counts the centre on the left side as outside the [lo, hi) span.
    sq = [(1, 0.0, 0.0, 4.0, 0.0), (1, 4.0, 0.0, 4.0, 4.0), (1, 4.0, 4.0, 0.0, 4.0), (1, 0.0, 4.0, 0.0, 0.0)]
    half = [(2, 2.5, 0.0, 9.0, 0.0), (2, 9.0, 0.0, 9.0, 9.0), (2, 9.0, 9.0, 2.5, 9.0), (2, 2.5, 9.0, 2.5, 0.0)]
    cells = spark.range(0, 25).select((F.col("id") % 5).alias("gx"), F.floor(F.col("id") / 5).alias("gy"))
    got = {(r.gx, r.gy) for r in polygon.mask_polygon(cells, spark.createDataFrame(sq, fx.EDGE_SCHEMA)).collect()}
    assert got == {(x, y) for x in range(4) for y in range(4)}
    got2 = {r.gx for r in polygon.mask_polygon(cells, spark.createDataFrame(half, fx.EDGE_SCHEMA)).collect()}
    assert got2 == {2, 3, 4}  # cx = 2.5 >= lo = 2.5 is inside


def test_one_by_one_raster_hillshade_is_flat(spark):
    df = spark.createDataFrame([(0, 0, 100)], "gx long, gy long, elev long")
    hs = focal.hillshade(df, "elev", 99.0, 33.0, 1.0, 1.0).collect()[0].hillshade
    assert hs == pytest.approx(255.0 * math.sin(math.radians(33.0)))


def test_odd_sized_pyramid_level(spark):
    df = spark.range(0, 9).select((F.col("id") % 3).alias("gx"), F.floor(F.col("id") / 3).alias("gy"),
                                  F.col("id").cast("double").alias("v"))
    p = {(r.zoom, r.gx, r.gy): r.value for r in focal.pyramid(df, "v", 2, 1, "bilinear").collect()}
    assert p[(1, 1, 1)] == 8.0          # lone corner child
    assert p[(1, 0, 1)] == pytest.approx((6 + 7) / 2)
    assert len([k for k in p if k[0] == 1]) == 4


def test_value_equal_to_colour_break(spark):
    df = spark.createDataFrame([(0.05,), (0.0500001,), (1.0,), (1.5,), (None,)], "v double")
    got = [r.c for r in df.select(co.colormap_le("v").alias("c")).collect()]
    assert got == [0xffffe5aa, 0xf7fcb9ff, 0x004529ff, 0, 0]


def test_class_without_label_keeps_null_name(spark):
    counts = spark.createDataFrame([(1, 5), (99, 2)], "value int, cells long")
    got = {r.value: r.name for r in zonal.label_lookup(counts, fx.crop_labels(spark)).collect()}
    assert got == {1: "Corn", 99: None}


def test_label_to_code_last_duplicate_wins(spark):
    labels = spark.createDataFrame([(64, "Shrubland"), (152, "Shrubland"), (65, "Barren"), (131, "Barren")],
                                   "code int, name string")
    got = {r.name: r.code for r in zonal.label_to_code(labels).collect()}
    assert got == {"Shrubland": 152, "Barren": 131}


def test_split_uri_without_key(spark):
    from gridsmith.operators import ingest
    df = spark.createDataFrame([("s3://bucket-only",), ("s3://b/k/x.TIF",)], "path string")
    b, k = ingest.split_uri(F.col("path"))
    got = [tuple(r) for r in df.select(b.alias("b"), k.alias("k")).collect()]
    assert got == [("bucket-only", ""), ("b", "k/x.TIF")]


def test_one_by_one_raster_windows(spark):
    from gridsmith.operators import ingest
    df = spark.createDataFrame([(1, 1)], "n_cols int, n_rows int")
    w = ingest.buffer_windows(ingest.list_windows(df)).collect()
    assert [(r.col_off, r.row_off, r.width, r.height, r.bcol0, r.bcol1, r.brow0, r.brow1) for r in w] == \
        [(0, 0, 1, 1, 0, 0, 0, 0)]


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
@pytest.mark.parametrize("top, lines", [(40.0, 12), (40.0, 13), (40.0, 20), (40.0, 34), (40.0, 50), (120.0, 10), (300.0, 50)])
def test_reproject_a_grid_that_reaches_past_the_pole(spark, top, lines, method):
    """Lines of 10 degrees: 12 from 40 north end short of the south pole, 13 at it, the others beyond one or both.  Every
    cell on Earth counts, cells beyond have no place, and the target ends at a latitude of MAX_LAT."""
    cells = {(x, y): 100.0 * y + x for x in range(2) for y in range(lines) if (x, y) != (1, 5)}
    df = spark.createDataFrame([(x, y, v) for (x, y), v in cells.items()], "gx long, gy long, v double")
    merc_y = lambda lat: geometry.EARTH_RADIUS * math.log(math.tan(math.radians(45 + max(-geometry.MAX_LAT, min(geometry.MAX_LAT, lat)) / 2)))
    size, y0, y1 = 400_000.0, merc_y(top), merc_y(top - 10 * lines)
    got = {(r.tx, r.ty): r.v for r in focal.reproject_lonlat_to_mercator(df, "v", 5.0, top, 10.0, size, method).collect()}
    want = {}
    for ty in range(math.floor((y0 - y1) / size)):
        lat = math.degrees(2 * math.atan(math.exp((y0 - (ty + 0.5) * size) / geometry.EARTH_RADIUS)) - math.pi / 2)
        for tx in range(math.floor(geometry.EARTH_RADIUS * math.radians(20) / size)):
            lon = math.degrees((tx + 0.5) * size / geometry.EARTH_RADIUS)
            sx, sy = lon / 10 - 0.5, (top - lat) / 10 - 0.5
            if method == "nearest":
                parts = [(cells.get((math.floor(sx + 0.5), math.floor(sy + 0.5))), 1.0)]
            else:
                parts = [(cells.get((math.floor(sx) + i, math.floor(sy) + j)), (sx % 1 if i else 1 - sx % 1) * (sy % 1 if j else 1 - sy % 1))
                         for j in (0, 1) for i in (0, 1)]
            parts = [(v, w) for v, w in parts if v is not None]
            if parts:
                want[tx, ty] = sum(v * w for v, w in parts) / sum(w for _, w in parts)
    assert set(got) == set(want) and len(want) > 100
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
