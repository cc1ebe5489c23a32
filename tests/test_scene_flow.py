"""The ingest flow and the bucketed join, in parts and as a whole."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsmith.operators import rasters as ra
from gridsmith.plans.registry import load_all
from gridsmith.session import shared_dir
from gridsmith.sources import bucketed as bu
from gridsmith.sources import catalog as cat
from tests.conftest import SF_SMALL

load_all()  # plans that reuse another module's oracle need it first
from gridsmith.plans import raster_plans as rp  # noqa: E402


def test_only_whole_windows_are_stacked(spark):
    rows = [(1, 0, 0, 2, 2, "a", [1.0, 2.0, 3.0, None]), (1, 0, 0, 2, 2, "b", [5.0, 6.0, 7.0, 8.0]), (1, 0, 0, 2, 2, "other", [9.0] * 4),
            (1, 2, 0, 2, 2, "a", [1.0] * 4),  # a band is missing
            (2, 0, 0, 2, 2, "a", [1.0] * 4), (2, 0, 0, 2, 1, "b", [1.0] * 2),  # heights differ
            (3, 0, 0, 2, 2, "a", [1.0] * 4), (3, 0, 0, 2, 2, "b", [1.0] * 3),  # no whole lines
            (4, 0, 0, 2, 2, "a", [1.0] * 4), (4, 0, 0, 2, 2, "a", [2.0] * 4),  # a band twice
            (5, 0, 0, 2, 2, "a", None), (5, 0, 0, 2, 2, "b", [1.0] * 4)]
    df = spark.createDataFrame(rows, "scene int, col_off int, row_off int, width int, height int, band string, cells array<double>")
    got = ra.stack_windows(df, {"a": "red", "b": "nir"}, keep=("scene",)).collect()
    assert [(r.scene, r.red, r.nir) for r in got] == [(1, [1.0, 2.0, 3.0, None], [5.0, 6.0, 7.0, 8.0])]
    assert ra.stack_windows(df.limit(0), {"a": "red"}, keep=("scene",)).count() == 0


def test_windows_resample_like_tiles_of_the_same_cells(spark):
    """Windows of other sizes and offsets, two scenes apart and two bands, one of which misses cells, against whole tiles."""
    rng, n = np.random.default_rng(3), 24
    source, target = ra.Grid(-100.0, 40.0, 0.01, n), ra.Grid(-11131949.0, 4866000.0, 1500.0, 10, "mercator")
    red, nir = rng.random((n, n)), rng.random((n, n))
    nir[rng.random((n, n)) < 0.5] = np.nan
    cells = lambda v: [None if math.isnan(x) else float(x) for x in v.ravel()]
    tile = spark.createDataFrame([(0, 0, cells(v), i) for i, v in enumerate((red, nir))], "col long, row long, cells array<double>, band int")
    want = {b: {(r.col, r.row): r.cells for r in ra.reproject_tiles(tile.where(F.col("band") == i).drop("band"), source, target).collect()}
            for i, b in enumerate(("red", "nir"))}
    cut = [(s, x, y, min(7, n - x), min(11, n - y), cells(red[y:y + 11, x:x + 7] * f), cells(nir[y:y + 11, x:x + 7]) if f == 1 else None)
           for s, f in ((1, 1), (2, 3)) for x in range(0, n, 7) for y in range(0, n, 11)]
    windows = spark.createDataFrame(cut, "scene int, gx long, gy long, width int, height int, red array<double>, nir array<double>").repartition(5)
    got = {(r.scene, r.col, r.row): r for r in ra.reproject_windows(windows, source, target, ["red", "nir"], extra=("scene",)).collect()}
    near = lambda a, b, f=1.0: all((x is None) == (y is None) and (x is None or abs(x - y * f) < 1e-9) for x, y in zip(a, b))
    assert {k[1:] for k in got if k[0] == 1} == set(want["red"])
    for key, cells_ in want["red"].items():
        assert near(got[1, *key].red, cells_) and near(got[2, *key].red, cells_, 3.0)
        assert near(got[1, *key].nir, want["nir"].get(key, [None] * 100)) and got[2, *key].nir == [None] * 100


def test_overlays_take_whole_pixels_in_order(spark):
    rows = [(0, 0, 1, [1.0, None, 3.0, None], [None, None, 1.0, None]), (0, 0, 2, [5.0, None, None, None], [6.0, None, None, None]),
            (0, 0, None, [7.0, 8.0, 9.0, None], [7.0, 8.0, 9.0, None])] + [(1, 0, 3, [1.0] * 4, [2.0] * 4)] * 2
    df = spark.createDataFrame(rows, "col long, row long, p int, red array<double>, nir array<double>")
    for parts in (1, 4):
        got = {r.col: (r.red, r.nir) for r in ra.overlay_tiles(df.repartition(parts), 2, ["red", "nir"], "p").collect()}
        assert got == {0: ([5.0, 8.0, 3.0, None], [6.0, 8.0, 1.0, None]), 1: ([1.0] * 4, [2.0] * 4)}


def test_a_repeated_batch_changes_nothing(spark):
    root, lines = shared_dir(spark, "scene_ingest"), rp.scene_lines(spark, SF_SMALL).where(F.col("scene") < 2)
    seen = []
    for _ in range(2):
        rp.ingest_scenes(lines, root, "s", 9, rp.LONLAT, rp.MERCATOR, rp.SCENE_BANDS, F.expr(rp.SCENE_X), F.expr(rp.SCENE_Y), rp.SCENE_WINDOW)
        seen.append((sorted(map(repr, cat.read_layer(spark, root, "s", 9).collect())), cat.read_meta(spark, root).drop("layer").collect()))
    assert seen[0] == seen[1] and seen[0][0] and seen[0][1][0].crs == "mercator"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_bucketed_join_shuffles_neither_side_and_splits_a_hot_tile(spark, no_broadcast):
    hot = [(0, 0, k, [float(k), None]) for k in range(400)] + [(1, 2, 1, [1.0, 2.0]), (1, 2, None, [3.0, 4.0]), (9, 9, 1, [0.0, 0.0])]
    imagery = spark.createDataFrame(hot, "col int, row int, day int, red array<double>").select(
        "col", "row", F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, day)").alias("instant"), "red")
    static = spark.createDataFrame([(0, 0, [7, 8]), (1, 2, [None, 9]), (5, 5, [1, 1])], "col long, row long, value array<int>")
    folder = shared_dir(spark, "bucketed")
    series, layer = bu.write_series(imagery, folder + "/a", 16), bu.write_static(static, folder + "/b", 16)
    both = bu.join_static(spark, series, layer)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    want = imagery.join(static, ["col", "row"])
    key = lambda df: sorted(map(repr, df.select("col", "row", "instant", "red", "value").collect()))
    assert key(both) == key(want.withColumns({"col": F.col("col").cast("long"), "row": F.col("row").cast("long")}))
    tasks = [r["count"] for r in both.where("col = 0").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 4 and max(tasks) < 200
