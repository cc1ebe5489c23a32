"""Property and edge-case tests: numpy re-statements of the folds, polygon
spans vs. brute force, pyramid/tiling/upsert invariants, streaming."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsmith.functions import color as co
from gridsmith.functions import indices as ix
from gridsmith.operators import focal, ingest, mosaic, polygon, tiles
from gridsmith.session import shared_dir
from gridsmith.sources import catalog as cat
from gridsmith.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _numpy_mosaic(stack):
    """The reference fold: newest first, replace where result dark & incoming bright."""
    stack = sorted(stack, key=lambda t: t[0], reverse=True)
    res = np.array(stack[0][1], dtype=np.int64)
    for _, px in stack[1:]:
        px = np.array(px)
        left = np.all(res[:3] < 6000)
        right = np.any(px[:3] >= 6000)
        if left and right:
            res = px.copy()
    return tuple(int(v) for v in res)


def test_mosaic_equals_numpy_fold(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    for p in range(200):
        stack = []
        for k in rng.sample(range(40), rng.randint(1, 6)):
            px = tuple(rng.choice([0, 3000, 5999, 6000, 9000]) for _ in range(4))
            stack.append((dt.datetime(2000, 1, 1) + dt.timedelta(days=k), px))
            rows.append((p, 0, stack[-1][0], *px))
        expect[p] = _numpy_mosaic(stack)
    df = spark.createDataFrame(rows, "gx long, gy long, instant timestamp_ntz, blue int, green int, red int, nir int")
    got = {r["gx"]: (r["blue"], r["green"], r["red"], r["nir"]) for r in mosaic.mosaic(df.repartition(5), "bright").collect()}
    assert got == expect


def test_mosaic_independent_of_partitioning(spark):
    l = ix.cloud_masked_bands(fx.landsat(spark, SF_SMALL))
    a = sorted(mosaic.mosaic(l.repartition(1), "greenest").collect())
    b = sorted(mosaic.mosaic(l.repartition(13, "instant"), "greenest").collect())
    assert a == b


def _brute_inside(edges, cx, cy):
    n = 0
    for _, x1, y1, x2, y2 in edges:
        if (y1 > cy) != (y2 > cy) and cx < (x2 - x1) * (cy - y1) / (y2 - y1) + x1:
            n += 1
    return n % 2 == 1


def test_polygon_spans_match_brute_force(spark):
    rng = random.Random(3)
    edges = []
    for pid in range(4):
        k = rng.randint(3, 9)
        pts = [(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(k)]
        for i in range(k):
            (x1, y1), (x2, y2) = pts[i], pts[(i + 1) % k]
            edges.append((pid, x1, y1, x2, y2))
    e = spark.createDataFrame(edges, fx.EDGE_SCHEMA)
    cells = spark.range(0, 400).select((F.col("id") % 20).alias("gx"), F.floor(F.col("id") / 20).alias("gy"))
    got = {(r.gx, r.gy) for r in polygon.mask_polygon(cells, e).collect()}
    want = set()
    for gx in range(20):
        for gy in range(20):
            for pid in range(4):
                if _brute_inside([x for x in edges if x[0] == pid], gx + 0.5, gy + 0.5):
                    want.add((gx, gy))
    assert got == want


def test_empty_polygon_masks_everything(spark):
    e = spark.createDataFrame([], fx.EDGE_SCHEMA)
    cells = spark.range(0, 16).select((F.col("id") % 4).alias("gx"), F.floor(F.col("id") / 4).alias("gy"))
    assert polygon.mask_polygon(cells, e).count() == 0


def test_pyramid_bilinear_preserves_mean_without_nodata(spark):
    cells = spark.range(0, 64 * 64).select((F.col("id") % 64).alias("gx"), F.floor(F.col("id") / 64).alias("gy"),
                                           (F.col("id") * 7 % 101).cast("double").alias("v"))
    p = focal.pyramid(cells, "v", 6, 0, "bilinear")
    means = {r["zoom"]: r["m"] for r in p.groupBy("zoom").agg(F.avg("value").alias("m")).collect()}
    assert len(means) == 7
    for m in means.values():
        assert m == pytest.approx(means[6], rel=1e-12)


def test_tiles_roundtrip(spark):
    t = fx.dem_tiles(spark, SF_SMALL)
    back = tiles.cells_to_tiles(tiles.tiles_to_cells(t, 8, value="elev"), 8, value="elev")
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, back.select("col", "row", F.col("cells")).collect()))


def test_upsert_is_idempotent(spark):
    root = shared_dir(spark, "test-catalog")
    l = fx.landsat(spark, SF_SMALL)
    keys = ["instant", "gx", "gy"]
    cat.upsert_layer(l, root, "landsat", 2, 8, keys)
    first = sorted(map(tuple, cat.read_layer(spark, root, "landsat", 2).collect()))
    cat.upsert_layer(l, root, "landsat", 2, 8, keys)
    second = sorted(map(tuple, cat.read_layer(spark, root, "landsat", 2).collect()))
    assert first == second
    assert len(first) == l.count()


def test_streaming_upsert(spark):
    from gridsmith.streaming.ingest import upsert_stream
    src = shared_dir(spark, "stream-src")
    root = shared_dir(spark, "stream-catalog")
    l = fx.landsat(spark, SF_SMALL)
    l.where(F.year("instant") < 1998).write.parquet(src + "/b1")
    l.where(F.year("instant") >= 1998).write.parquet(src + "/b2")
    stream = spark.readStream.schema(l.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    q = upsert_stream(stream, root, "landsat", 2, 8, ["instant", "gx", "gy"], shared_dir(spark, "stream-ckpt"))
    q.awaitTermination(120)
    assert cat.read_layer(spark, root, "landsat", 2).count() == l.count()


def test_hsv_roundtrip(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 255), rng.randint(0, 255), rng.randint(0, 255)) for i in range(300)]
    df = spark.createDataFrame(rows, "gx long, r int, g int, b int")
    h = co.rgb_to_hsv(df, "r", "g", "b", "_")
    out = co.hsv_to_rgb_df(h, "_h", "_s", "_v", ("r2", "g2", "b2"))
    for r in out.collect():
        assert (r.r2, r.g2, r.b2) == pytest.approx((r.r, r.g, r.b), abs=1e-9)


def test_ndvi_edge_cases(spark):
    df = spark.createDataFrame([(0, 0, 0), (100, 100, 65535), (50, 150, 20480)], "red int, nir int, qa int")
    out = df.select(ix.ndvi("red", "nir").alias("n"), ix.ndvi_safe("red", "nir").alias("s"),
                    ix.is_cloud("qa").alias("c")).collect()
    assert out[0].n is None and out[0].s == 0.0
    assert out[1].c is True and out[2].c is False
    assert out[2].n == pytest.approx(0.5)


def test_band_sets_four_and_six_rows(spark):
    rows = [(1, b, b) for b in range(1, 5)] + [(2, b, b) for b in range(1, 7)] + [(3, b, b) for b in range(1, 6)]
    df = spark.createDataFrame(rows, "scene long, band int, v long")
    assert [r.scene for r in ingest.complete_band_sets(df).select("scene").distinct().collect()] == [3]
    st = ingest.stack_bands(df).collect()
    assert st[0].bands == [1, 2, 3, 4, 5]


def test_partial_window_kept(spark):
    df = spark.createDataFrame([(513, 1)], "n_cols int, n_rows int")
    w = ingest.list_windows(df).collect()
    assert sorted((r.col_off, r.width) for r in w) == [(0, 512), (512, 1)]


def test_drop_columns_and_parallelize(spark):
    rows = [("SC1", 1, "s3://b/k", "w")]
    df = spark.createDataFrame(rows, "scene_id string, band int, uri string, window string").repartition(4)
    assert df.drop("window", "uri").columns == ["scene_id", "band"]


def test_upsert_rewrites_only_touched_months(spark):
    import glob
    import os
    root = shared_dir(spark, "test-catalog-months")
    l = fx.landsat(spark, SF_SMALL)
    keys = ["instant", "gx", "gy"]
    cat.upsert_layer(l.where(F.year("instant") <= 1998), root, "landsat", 2, 8, keys)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/layer=landsat/zoom=2/written=*/ym=1995*/*.parquet")}
    assert before
    cat.upsert_layer(l.where(F.year("instant") == 1999), root, "landsat", 2, 8, keys)
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/layer=landsat/zoom=2/written=*/ym=1995*/*.parquet")}
    assert before == after
    assert cat.read_layer(spark, root, "landsat", 2).count() == l.where(F.year("instant") <= 1999).count()


def test_shared_dir_when_checkpoint_dir_unset(spark):
    """With no spark.checkpoint.dir configured, a local folder is created and
    registered with the context (the setting itself is not runtime-mutable)."""
    import types

    class _Conf:
        def get(self, key, default=None):
            return None if key == "spark.checkpoint.dir" else spark.conf.get(key, default)

    class _Ctx:
        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    fake = types.SimpleNamespace(conf=_Conf(), sparkContext=_Ctx())
    p = shared_dir(fake, "t")
    assert fake.sparkContext.dir is not None and p.startswith(fake.sparkContext.dir.rstrip("/") + "/t/")


def test_tile_pyramid_levels_per_shuffle_agree(spark):
    from gridsmith.operators import tile_grain as tg
    t = fx.dem_tiles(spark, SF_SMALL)
    res = {}
    for lps in (1, 2, 3):
        p = tg.pyramid(t, 8, 7, 2, "bilinear", levels_per_shuffle=lps)
        res[lps] = sorted((r.zoom, r.col, r.row, tuple(round(v, 9) if v is not None else None for v in r.cells))
                          for r in p.collect())
    assert res[1] == res[2] == res[3]


def test_python_tasks_do_not_need_the_package_on_workers(tmp_path):
    """Functions of this package are pickled by value, so Python workers that
    cannot import it (driver started from another folder, executors without
    the package) still run the numpy tasks."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "import __spark_entry__ as E\n"
            "from gridsmith.session import build_session\n"
            "s = build_session('local[2]', 2); s.sparkContext.setLogLevel('OFF')\n"
            "print('ROWS', E.queries()['hillshade_tiles'](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 32000" in r.stdout, r.stderr[-2000:]


def test_polygon_mask_across_many_x_buckets(spark):
    """Wide polygons span several join buckets; results equal brute force."""
    edges = [(1, 3.3, 2.2, 1190.7, 9.1), (1, 1190.7, 9.1, 600.4, 17.6), (1, 600.4, 17.6, 3.3, 2.2),
             (2, 500.0, 1.0, 520.0, 1.0), (2, 520.0, 1.0, 520.0, 19.0), (2, 520.0, 19.0, 500.0, 19.0),
             (2, 500.0, 19.0, 500.0, 1.0)]
    e = spark.createDataFrame(edges, fx.EDGE_SCHEMA)
    cells = spark.range(0, 1200 * 20).select((F.col("id") % 1200).alias("gx"), F.floor(F.col("id") / 1200).alias("gy"))
    got = {(r.gx, r.gy) for r in polygon.mask_polygon(cells, e).collect()}
    want = {(gx, gy) for gx in range(1200) for gy in range(20)
            if any(_brute_inside([x for x in edges if x[0] == pid], gx + 0.5, gy + 0.5) for pid in (1, 2))}
    assert got == want
    tagged = polygon.cells_in_polygons(cells, e).groupBy("gx", "gy", "poly_id").count()
    assert tagged.where("count > 1").count() == 0


def test_tiles_intersecting_matches_brute_force(spark):
    rng = random.Random(11)
    edges = []
    for pid in range(3):
        k = rng.randint(3, 8)
        pts = [(rng.uniform(0, 96), rng.uniform(0, 96)) for _ in range(k)]
        edges += [(pid, *pts[i], *pts[(i + 1) % k]) for i in range(k)]
    e = spark.createDataFrame(edges, fx.EDGE_SCHEMA)
    tiles_df = spark.range(0, 144).select((F.col("id") % 12).alias("col"), F.floor(F.col("id") / 12).alias("row"))
    got = {(r.col, r.row) for r in polygon.tiles_intersecting(tiles_df, e, 8).collect()}
    want = set()
    for gx in range(96):
        for gy in range(96):
            if any(_brute_inside([x for x in edges if x[0] == pid], gx + 0.5, gy + 0.5) for pid in range(3)):
                want.add((gx // 8, gy // 8))
    assert got == want


def test_tile_mask_equals_cell_mask_across_buckets(spark):
    from gridsmith.operators import tile_grain as tg
    edges = [(1, 3.3, 2.2, 3190.7, 9.1), (1, 3190.7, 9.1, 600.4, 17.6), (1, 600.4, 17.6, 3.3, 2.2),
             (2, 500.0, 1.0, 520.0, 1.0), (2, 520.0, 1.0, 520.0, 19.0), (2, 520.0, 19.0, 500.0, 19.0),
             (2, 500.0, 19.0, 500.0, 1.0)]
    e = spark.createDataFrame(edges, fx.EDGE_SCHEMA)
    cells = spark.range(0, 3200 * 24).select((F.col("id") % 3200).alias("gx"), F.floor(F.col("id") / 3200).alias("gy"),
                                             F.lit(1).alias("value"))
    want = {(r.gx, r.gy) for r in polygon.mask_polygon(cells, e).collect()}
    t = tiles.cells_to_tiles(cells, 8, value="value")
    got = {(r.gx, r.gy) for r in tiles.tiles_to_cells(tg.mask_polygon(t, e, 8), 8, value="value").collect()}
    assert got == want and len(want) > 1000
