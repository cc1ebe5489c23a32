"""Cases that used to lose data or change behaviour."""

import json
import random
import time
from fractions import Fraction

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridsmith import session
from gridsmith.operators import tile_grain, tiles
from gridsmith.operators.geometry import ring_to_edges
from gridsmith.operators.polygon import row_spans, tiles_touched
from gridsmith.sources import catalog
from gridsmith.sources import fixtures as fx
from gridsmith.sources import scenes as sc

SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]
FAR = [[[x + 10, y] for x, y in SQUARE]]


def cells(spark, rows):
    return spark.createDataFrame(rows, "gx long, gy long, instant string, value int").withColumn(
        "instant", F.col("instant").cast("timestamp_ntz"))


def test_upsert_raises_on_a_metadata_error_and_keeps_the_layer(spark, monkeypatch):
    root = session.shared_dir(spark, "upsert_error")
    rows = [(i, 0, "2001-01-05", i) for i in range(5)]
    keys = ["gx", "gy", "instant"]
    catalog.upsert_layer(cells(spark, rows), root, "l", 1, 8, keys)
    with monkeypatch.context() as m:
        m.setattr(catalog, "read_manifest", lambda *a: (_ for _ in ()).throw(OSError("store is away")))
        with pytest.raises(OSError):
            catalog.upsert_layer(cells(spark, rows[:1]), root, "l", 1, 8, keys)
    assert catalog.read_layer(spark, root, "l", 1).count() == 5


def test_upsert_replay_and_repeated_keys(spark):
    root = session.shared_dir(spark, "upsert_replay")
    keys = ["gx", "gy", "instant"]
    batch = [(i, 0, f"2001-0{1 + i % 2}-05", i) for i in range(5)] + [(0, 0, "2001-01-05", 77)]
    for _ in range(3):
        catalog.upsert_layer(cells(spark, batch), root, "l", 1, 8, keys)
        assert catalog.read_layer(spark, root, "l", 1).count() == 5
        assert catalog.read_meta(spark, root).first()["cells"] == 5


@pytest.mark.parametrize("text, edges", [
    ({"type": "Polygon", "coordinates": [SQUARE]}, 4), ({"type": "Polygon", "coordinates": [SQUARE, HOLE]}, 8),
    ({"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE], FAR]}, 12),
    ({"type": "Feature", "id": "f", "geometry": {"type": "Polygon", "coordinates": [SQUARE]}}, 4),
    ({"type": "FeatureCollection", "features": [{"geometry": {"type": "MultiPolygon", "coordinates": [FAR, [SQUARE]]}},
                                               {"geometry": {"type": "Polygon", "coordinates": [SQUARE]}}]}, 8),
    ({"type": "Polygon", "coordinates": [SQUARE[:-1]]}, 4), ({"type": "Point", "coordinates": [1.0, 2.0]}, 0)])
def test_geojson_geometries(spark, tmp_path, text, edges):
    for indent in (None, 2):
        path = tmp_path / f"{indent}.json"
        path.write_text(json.dumps(text, indent=indent))
        assert sc.read_geojson_polygons(spark, str(path), multi_line=indent is not None).count() == edges


def test_a_hole_is_outside(spark):
    rings = spark.createDataFrame([("p", SQUARE), ("p", HOLE[:-1])], "poly_id string, ring array<array<double>>")
    spans = {(r.gy, r.lo, r.hi) for r in row_spans(ring_to_edges(rings)).collect()}
    assert spans == {(0, 0.0, 4.0), (1, 0.0, 1.0), (1, 2.0, 4.0), (2, 0.0, 4.0), (3, 0.0, 4.0)}


def test_class_counts_keep_fractions(spark):
    t = spark.createDataFrame([(0, 0, [1.2, 1.7, 2.0, -1.5])], "col long, row long, cells array<double>")
    assert {(r.value, r.cells) for r in tile_grain.class_counts(t).collect()} == {(1.2, 1), (1.7, 1), (2.0, 1), (-1.5, 1)}


def test_tile_gather_is_near_linear(spark):
    def seconds(n):
        c = spark.range(n * n).select((F.col("id") % n).alias("gx"), F.floor(F.col("id") / n).alias("gy"), F.col("id").alias("value"))
        began = time.time()
        rows = tiles.cells_to_tiles(c.where("value % 3 > 0"), n).collect()
        assert len(rows) == 1 and rows[0].cells == [v if v % 3 else None for v in range(n * n)]
        return time.time() - began
    seconds(16)
    assert seconds(256) < 15


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        session.shared_dir(Session)


def meets(edge, box):
    """Whether a segment meets a closed box, in exact arithmetic."""
    x1, y1, x2, y2 = map(Fraction, edge)
    lo, hi = Fraction(0), Fraction(1)
    for d, at, a, b in ((x2 - x1, x1, box[0], box[2]), (y2 - y1, y1, box[1], box[3])):
        if not d and not a <= at <= b:
            return False
        if d:
            t = sorted(((a - at) / d, (b - at) / d))
            lo, hi = max(lo, t[0]), min(hi, t[1])
    return lo <= hi


def crossings(edges, x, y):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for x1, y1, x2, y2 in edges)


SHAPES = [[(3.6, 3.6), (3.9, 3.6), (3.9, 3.9)],  # smaller than a cell, no centre
          [(1.0, 20.1), (90.0, 20.3), (90.0, 20.2)],  # a sliver
          [(16.0, 16.0), (20.0, 18.0), (18.0, 20.0)],  # touches a corner of four tiles
          [(8.0, 8.0), (64.0, 8.0), (64.0, 64.0), (8.0, 64.0)]]  # borders on tile borders
RANDOM = [[(random.Random(s * 9 + k).uniform(0, 96), random.Random(s * 9 + k + 500).uniform(0, 96)) for k in range(3 + s)] for s in range(5)]


@pytest.mark.parametrize("points", SHAPES + RANDOM)
def test_tiles_touched_matches_exact_intersection(spark, points):
    edges = [(*points[i], *points[(i + 1) % len(points)]) for i in range(len(points))]
    e = spark.createDataFrame([(1, *x) for x in edges], fx.EDGE_SCHEMA)
    grid = spark.range(196).select((F.col("id") % 14 - 1).alias("col"), (F.floor(F.col("id") / 14) - 1).alias("row"))
    want = {(c, r) for c in range(-1, 13) for r in range(-1, 13)
            if any(meets(x, (8 * c, 8 * r, 8 * c + 8, 8 * r + 8)) for x in edges) or crossings(edges, 8 * c + 4.0, 8 * r + 4.0) % 2}
    assert {(r.col, r.row) for r in tiles_touched(grid, e, 8).collect()} == want


def test_layer_query_keeps_tiles_without_a_centre_inside(spark):
    root = session.shared_dir(spark, "touched")
    catalog.write_layer(cells(spark, [(x, y, "2001-01-05", 1) for x in range(24) for y in range(24)]), root, "l", 1, 8, "int32", 0)
    for points, want in ((SHAPES[0], {(0, 0)}), (SHAPES[2], {(c, r) for c in (1, 2) for r in (1, 2)})):
        e = spark.createDataFrame([(1, *points[i], *points[(i + 1) % 3]) for i in range(3)], fx.EDGE_SCHEMA)
        got = catalog.query_layer(spark, root, "l", 1, 8, e).groupBy(F.floor(F.col("gx") / 8), F.floor(F.col("gy") / 8)).count().collect()
        assert {(r[0], r[1]) for r in got} == want and {r[2] for r in got} == {64}
