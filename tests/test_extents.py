"""Extents inside polygons, scene search, first matches and the cut of a layer to where another one is."""

import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridsmith import api as gs

RINGS = {1: [[(0, 0), (40, 0), (40, 40), (20, 14), (0, 40)]],                                  # a bay
         2: [[(2, 2), (38, 2), (38, 38), (2, 38)], [(12, 12), (26, 12), (26, 26), (12, 26)]],  # a hole
         3: [[(-30, 0), (-4, 6), (-20, 30)], [(-30, 31), (-5, 31), (-5, 39), (-30, 39)]]}      # two parts


def edges_of(rings):
    return [(*p, *q) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1])]


def inside_exactly(box, edges):
    """No edge has a point in the open box (clipped by its parameter), and the centre is inside, in fractions."""
    x0, y0, x1, y1 = map(Fraction, box)
    crossings = 0
    for ax, ay, bx, by in edges:
        lo, hi, out = Fraction(0), Fraction(1), False
        for a, b, low, high in ((ax, bx, x0, x1), (ay, by, y0, y1)):
            if a == b:
                out |= not low < a < high
            else:
                t = sorted((Fraction(low - a, b - a), Fraction(high - a, b - a)))
                lo, hi = max(lo, t[0]), min(hi, t[1])
        if not out and lo < hi:
            return False
        cx, cy = (x0 + x1) / 2, (y0 + y1) / 2
        if (ay > cy) != (by > cy) and cx < Fraction(bx - ax) * (cy - ay) / (by - ay) + ax:
            crossings += 1
    return crossings % 2 == 1


def test_extents_within_against_exact_arithmetic(spark):
    rnd = random.Random(1)
    boxes = [(i, x := rnd.randint(-32, 40), y := rnd.randint(-3, 40), x + rnd.randint(1, 9), y + rnd.randint(1, 9)) for i in range(1500)]
    boxes += [(2000, 2, 2, 38, 12), (2001, 2, 2, 38, 13), (2002, 12, 12, 26, 26), (2003, -30, 31, -5, 39), (2004, 0, 0, 41, 4), (2005, 10, 0, 30, 14)]
    rows = spark.createDataFrame([(i, *map(float, b)) for i, *b in boxes] + [(3000, None, 1.0, 2.0, 2.0), (3001, 5.0, 5.0, 5.0, 6.0)],
                                 "id int, xmin double, ymin double, xmax double, ymax double")
    for kept in ({1}, {2}, {3}, {1, 2, 3}):
        edges = [(k, *map(float, e)) for k in kept for e in edges_of(RINGS[k])]
        got = gs.extents_within(rows, spark.createDataFrame(edges, "poly_id int, x1 double, y1 double, x2 double, y2 double"))
        want = {i for i, *b in boxes if any(inside_exactly(b, edges_of(RINGS[k])) for k in kept)}
        assert got.columns == rows.columns and {r.id for r in got.collect()} == want and len(want) > 20
    none = spark.createDataFrame([], "poly_id int, x1 double, y1 double, x2 double, y2 double")
    assert gs.extents_within(rows, none).count() == 0


def test_extents_within_keeps_repeated_rows_and_gathers_nothing(spark):
    edges = spark.createDataFrame([(1, *map(float, e)) for e in edges_of(RINGS[1])], "poly_id int, x1 double, y1 double, x2 double, y2 double")
    rows = spark.createDataFrame([(1.0, 1.0, 2.0, 2.0)] * 50 + [(19.0, 20.0, 21.0, 22.0)] * 50, "xmin double, ymin double, xmax double, ymax double")
    got = gs.extents_within(rows, edges)
    assert got.count() == 50
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "collect_list" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_search_pages_and_first_match(spark):
    t = lambda d: dt.datetime(2001, 1, d)
    rows = spark.createDataFrame([(i, t(1 + i % 9), float(i), float(i) + 2, i * 7 % 30) for i in range(40)] + [(99, None, 0.0, 1.0, None)],
                                 "id int, time timestamp_ntz, a double, b double, cloud int")
    ext = [F.col(c) for c in ("a", "a", "b", "b")]
    got = gs.search_scenes(rows, F.col("time"), (t(2), t(4)), ext, (4.0, 4.0, 30.0, 30.0), F.col("cloud"), 10)
    want = [i for i in range(40) if 2 <= 1 + i % 9 <= 4 and i < 30 and i + 2 > 4 and i * 7 % 30 <= 10]
    assert sorted(r.id for r in got.collect()) == want and want
    assert gs.search_scenes(rows).count() == 41
    pages = [[r.id for r in gs.result_page(rows, ["id"], k, 12).collect()] for k in range(5)]
    assert sum(pages, []) == sorted([*range(40), 99]) and [len(p) for p in pages] == [12, 12, 12, 5, 0]
    a = spark.createDataFrame([(1, [3, 8, 9]), (2, [1]), (3, []), (4, None), (5, [None, 7])], "id int, a array<int>")
    found = {r.id: r.f for r in a.select("id", gs.first_match(F.col("a"), lambda x: x > 5).alias("f")).collect()}
    assert found == {1: 8, 2: None, 3: None, 4: None, 5: 7}


def test_near_cells(spark):
    rnd = random.Random(3)
    cells = [(rnd.randint(1, 2), x, y) for x in range(-20, 60) for y in range(-20, 60)]
    others = [(1, -8, 7), (2, 39, 40), (1, 16, 16)]
    df = lambda r: spark.createDataFrame(r, "zoom int, gx int, gy int")
    got = {(r.zoom, r.gx, r.gy) for r in gs.near_cells(df(cells), df(others), margin=2, side=8).collect()}
    must = {c for c in cells if any(c[0] == z and abs(c[1] - x) <= 2 and abs(c[2] - y) <= 2 for z, x, y in others)}
    blocks = {(z, (x + a) // 8, (y + b) // 8) for z, x, y in others for a in (-2, 0, 2) for b in (-2, 0, 2)}
    assert must <= got and got == {c for c in cells if (c[0], c[1] // 8, c[2] // 8) in blocks}


def test_composites_join_by_level(spark):
    df = lambda name: spark.createDataFrame([(z, 0, y, z * 10 + y) for z in (1, 2) for y in range(3)], f"zoom int, gx int, gy int, {name} int")
    got = gs.composite_join(df("a"), df("b"), df("c")).collect()
    assert len(got) == 6 and all(r.a == r.b == r.c for r in got)
    flat = gs.composite_join(*(df(c).where("zoom = 1").drop("zoom") for c in "abc"))
    assert flat.count() == 3
    with pytest.raises(ValueError):
        gs.composite_join(df("a"), df("b").drop("zoom"), df("c"))
