"""Multiband pyramids and catalog metadata against numpy restatements."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsmith.operators import band_pyramid as bp
from gridsmith.operators import ingest as ig
from gridsmith.operators.rasters import Grid
from gridsmith.session import shared_dir
from gridsmith.sources import catalog as cat

N, ZOOM = 4, 6
BANDS = ["red", "nir"]


def base(seed=0):
    """{(instant, band, gx, gy): value} and tiles: scattered tiles, missing cells, a band that misses a whole tile."""
    rng = np.random.default_rng(seed)
    cells, rows = {}, []
    for t in (1, 2):
        for c, r in [(0, 0), (1, 0), (3, 2), (37, 40), (63, 63)]:
            bands = []
            for b in BANDS:
                v = rng.integers(0, 100, N * N).astype(float)
                v[rng.random(N * N) < 0.4] = np.nan
                if (t, c, b) == (2, 37, "nir"):
                    v[:] = np.nan
                bands.append([None if math.isnan(x) else float(x) for x in v])
                cells |= {(t, b, c * N + k % N, r * N + k // N): x for k, x in enumerate(v) if not math.isnan(x)}
            rows.append((t, c, r, *bands))
    return cells, rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "t int, col long, row long, red array<double>, nir array<double>")
    return df.withColumn("instant", F.expr("timestamp_ntz'2020-01-01' + make_interval(0, t)")).drop("t").repartition(3)


def expected(cells, zoom):
    sums = {}
    for (t, b, x, y), v in cells.items():
        s = sums.setdefault((t, b, x >> (ZOOM - zoom), y >> (ZOOM - zoom)), [0.0, 0])
        s[0] += v
        s[1] += 1
    return {k: s / n for k, (s, n) in sums.items()}


def cells_of(rows):
    return {(r.instant.month - 1, b, r.col * N + k % N, r.row * N + k // N): x
            for r in rows for b in BANDS for k, x in enumerate(r[b]) if x is not None}


def test_levels_weigh_present_cells(spark):
    """Passes of four levels and of less than a tile: every cell is the mean of the base cells below it."""
    cells, rows = base()
    levels = bp.band_pyramid(frame(spark, rows), N, ZOOM, BANDS, 0, ("instant",)).collect()
    assert {r.zoom for r in levels} == set(range(ZOOM))
    for z in range(ZOOM):
        got, want = cells_of([r for r in levels if r.zoom == z]), expected(cells, z)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_written_levels_have_metadata_and_a_rerun_changes_nothing(spark):
    cells, rows = base(1)
    root, grid = shared_dir(spark, "pyr"), Grid(10.0, 50.0, 0.5, N)

    def state():
        levels = {z: sorted(map(repr, cat.read_layer(spark, root, "l", z).collect())) for z in range(ZOOM, -1, -1)}
        return levels, sorted(map(repr, cat.read_meta(spark, root).collect()))

    bp.write_pyramid(frame(spark, rows), root, "l", N, ZOOM, BANDS, grid=grid)
    first = state()
    meta = {m.zoom: m for m in cat.read_meta(spark, root).collect()}
    assert set(meta) == set(range(ZOOM + 1))
    assert all(m.cells == len(first[0][z]) and m.crs == "lonlat" and m.x_min == 10.0 for z, m in meta.items())
    assert meta[ZOOM].x_max == 10.0 + 64 * N * 0.5 and meta[0].x_max == 10.0 + N * 0.5 * 2 ** ZOOM
    bp.write_pyramid(frame(spark, rows), root, "l", N, ZOOM, BANDS, grid=grid)
    assert state() == first


def test_thirteen_levels(spark):
    tiles = spark.createDataFrame([(8191, 8191, [1.0, 2.0, 3.0, None])], "col long, row long, v array<double>")
    levels = bp.band_pyramid(tiles, 2, 13, ["v"]).collect()
    assert sorted(r.zoom for r in levels) == list(range(13))
    assert all([x for x in r.v if x is not None] == [2.0] and (r.col, r.row) == (2 ** r.zoom - 1,) * 2 for r in levels)


def test_pyramid_of_odd_tiles_raises(spark):
    tiles = spark.createDataFrame([(0, 0, [1.0] * 9)], "col long, row long, v array<double>")
    with pytest.raises(ValueError, match="power of two"):
        bp.band_pyramid(tiles, 3, 1, ["v"])


@pytest.mark.parametrize("change", [{"tile_size": 16}, {"cell_type": "uint8"}, {"nodata": 7}, {"grid": Grid(0.0, 0.0, 1.0, 8, "mercator")}])
def test_metadata_that_conflicts_raises(spark, change):
    cells = spark.createDataFrame([(1, 2, 3)], "gx long, gy long, v int")
    args = {"tile_size": 8, "cell_type": "int32", "nodata": 0, "grid": Grid(0.0, 0.0, 1.0, 8, "lonlat")}
    a, b, c = (cat.layer_meta(cells, "l", 1, **x) for x in (args, args | change, args | {"grid": None}))
    assert cat.merge_meta(a, c).first().crs == "lonlat"
    with pytest.raises(Exception, match="differ in"):
        cat.merge_meta(a, b).collect()


def test_shapes_that_cannot_be_stacked_are_named(spark):
    rows = [(1, 2, 4), (1, 2, 4), (2, 2, 4), (2, 4, 4), (3, 2, 5), (4, 1, 0), (5, 2, 4), (5, 2, 8)]
    df = spark.createDataFrame(rows, "scene int, width int, n int").withColumn("cells", F.array_repeat(F.lit(1), F.col("n")))
    got = {r.scene: (r.n_rows, r.shapes) for r in ig.array_shape_check(df).collect()}
    assert got == {2: (2, ["2x2", "4x1"]), 3: (1, ["2x2.5"]), 5: (2, ["2x2", "2x4"])}
