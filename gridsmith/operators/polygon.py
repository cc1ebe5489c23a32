"""Polygon predicates on the cell grid without a geometry library.

Polygons are *edge tables* ``(poly_id, x1, y1, x2, y2)`` in pixel units;
a cell ``(gx, gy)`` has its centre at ``(gx + 0.5, gy + 0.5)``.  The inside
test is the even-odd rule: a centre is inside when an odd number of edges
cross the ray to its right.  Holes and multi-rings come free.

Instead of testing every cell against every edge (cells x edges work), we
turn the polygon into *row spans*: for each pixel row the crossings are
sorted and paired, giving half-open intervals ``[lo, hi)`` of centre x.
Spans grow with the polygon's perimeter, not the raster, and the mask
becomes an equi-join on ``gy`` plus a range test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsmith.plans.sizing import broadcast_if_bounded


def crossing_rows(edges: DataFrame) -> DataFrame:
    """``(poly_id, gy, xi)``: each edge meets each row centre it spans at ``xi``."""
    ymin = F.least("y1", "y2")
    ymax = F.greatest("y1", "y2")
    rows = edges.select("*", F.explode(F.sequence(F.floor(ymin) - 1, F.ceil(ymax) + 1)).alias("gy"))
    cy = F.col("gy") + F.lit(0.5)
    crosses = (F.col("y1") > cy) != (F.col("y2") > cy)
    xi = F.try_divide((F.col("x2") - F.col("x1")) * (cy - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")
    return rows.where(crosses).select("poly_id", "gy", xi.alias("xi"))


def row_spans(edges: DataFrame) -> DataFrame:
    """``(poly_id, gy, lo, hi)``: centres with ``lo <= cx < hi`` are inside."""
    w = Window.partitionBy("poly_id", "gy").orderBy("xi")
    x = crossing_rows(edges).withColumn("k", F.floor((F.row_number().over(w) - 1) / 2))
    return (x.groupBy("poly_id", "gy", "k")
            .agg(F.min("xi").alias("lo"), F.max("xi").alias("hi"), F.count("*").alias("n"))
            .where("n = 2").drop("k", "n"))


def pixel_bound(edges: DataFrame) -> int:
    """Upper bound on the pixels inside the polygons: the pixels under each
    polygon's bounding box.  A spatial layer (one row per pixel) masked by
    the polygons has at most this many rows — a bound that costs one tiny
    aggregate over the edges, never a pass over the data."""
    b = polygon_bounds(edges).agg(
        F.sum((F.ceil("xmax") - F.floor("xmin") + 1) * (F.ceil("ymax") - F.floor("ymin") + 1)).alias("b")).first()
    return int(b["b"] or 0)


MIN_X_BUCKET = 256   # pixels per join bucket along x (at least)
MAX_BUCKETS = 64     # buckets per span (at most): bucket width grows with the widest polygon


def bucketed_spans(edges: DataFrame, min_width: int = MIN_X_BUCKET) -> tuple[DataFrame, int, int]:
    """Row spans keyed by ``(gy, xb)``, ``xb`` a bucket of ``w`` pixels along x.

    With many polygons a pixel row holds many spans; keying the join on the
    x bucket as well means each cell (or tile) only meets the spans of its
    own bucket.  Each span is listed under every bucket it overlaps (widened
    by a pixel; the exact test stays in the join condition); ``w`` starts at
    ``min_width`` and doubles until no span lists more than ~``MAX_BUCKETS``
    buckets.  Returns (spans, w, row bound) — the bound comes from the edges
    alone, so callers can broadcast on a proof."""
    stats = edges.agg(
        F.sum(F.ceil(F.greatest("y1", "y2")) - F.floor(F.least("y1", "y2")) + 3).alias("rows"),
        (F.greatest(F.max("x1"), F.max("x2")) - F.least(F.min("x1"), F.min("x2"))).alias("width")).first()
    rows, width = int(stats["rows"] or 0), float(stats["width"] or 0.0)
    w = min_width
    while width / w > MAX_BUCKETS:
        w *= 2
    spans = row_spans(edges)
    b0 = F.floor((F.col("lo") - F.lit(1.0)) / F.lit(float(w)))
    b1 = F.floor(F.col("hi") / F.lit(float(w)))
    keyed = spans.select("poly_id", "gy", "lo", "hi", F.explode(F.sequence(b0, b1)).alias("xb"))
    return keyed, w, rows * (int(width // w) + 3)


def _spans_for_join(edges: DataFrame) -> tuple[DataFrame, int]:
    keyed, w, bound = bucketed_spans(edges)
    return broadcast_if_bounded(keyed, bound), w


def _inside(w: int) -> Column:
    cx = F.col("c.gx") + F.lit(0.5)
    return ((F.col("c.gy") == F.col("s.gy")) & (F.floor(F.col("c.gx") / F.lit(float(w))) == F.col("s.xb"))
            & (cx >= F.col("s.lo")) & (cx < F.col("s.hi")))


def mask_polygon(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Keep the cells whose centre lies inside any polygon (C4).

    Cells outside become NoData; in the sparse cell grain NoData cells are
    simply absent, so this is a semi join (never duplicates a cell)."""
    spans, w = _spans_for_join(edges)
    return cells.alias("c").join(spans.alias("s"), _inside(w), "left_semi")


def cells_in_polygons(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Cells tagged with every polygon they lie in: ``poly_id`` + cell columns
    (C9).  A cell meets each polygon's span at most once (one bucket, spans
    of one polygon in a row are disjoint), so nothing is duplicated."""
    spans, w = _spans_for_join(edges)
    return (cells.alias("c").join(spans.alias("s"), _inside(w), "inner")
            .select(F.col("s.poly_id").alias("poly_id"), "c.*"))


def polygon_bounds(edges: DataFrame) -> DataFrame:
    """Bounding box per polygon (H8)."""
    return edges.groupBy("poly_id").agg(
        F.least(F.min("x1"), F.min("x2")).alias("xmin"), F.least(F.min("y1"), F.min("y2")).alias("ymin"),
        F.greatest(F.max("x1"), F.max("x2")).alias("xmax"), F.greatest(F.max("y1"), F.max("y2")).alias("ymax"))


def polygon_centroid(edges: DataFrame) -> DataFrame:
    """Area-weighted centroid by the shoelace sums (H8); holes subtract when
    their rings run the other way, as in any simple-feature centroid."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    a = edges.groupBy("poly_id").agg(
        (F.sum(cross) / 2).alias("area"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("sx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("sy"))
    return a.select("poly_id", F.abs("area").alias("area"),
                    F.try_divide(F.col("sx"), 6 * F.col("area")).alias("cx"),
                    F.try_divide(F.col("sy"), 6 * F.col("area")).alias("cy"))


def extents_within(rows: DataFrame, edges: DataFrame, box=("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """Rows whose extent (columns ``box``) lies inside one of the polygons (B8), borders included; concave polygons, holes and
    several rings follow by the even-odd rule.

    A box is inside if no edge enters its open inside and its centre is inside.  Edges and distinct boxes meet by ``MAX_BUCKETS``
    bands of y; an edge meets the open box
    unless an axis or the edge's own normal separates them.  Crossings right of the centre are counted in the band of the
    centre, so each edge counts once.  Nothing is gathered: the counts are partial aggregates.  Extents with a null or without area lie
    in no polygon.  Signs are those of double arithmetic: exact for whole-numbered coordinates up to 2^25."""
    x0, y0, x1, y1 = box
    boxes = rows.select(*box).where((F.col(x0) < F.col(x1)) & (F.col(y0) < F.col(y1))).distinct()
    e = edges.agg(F.count("*").alias("n"), F.min(F.least("y1", "y2")).alias("lo"), F.max(F.greatest("y1", "y2")).alias("hi"),
                  F.sum(F.abs(F.col("y2") - F.col("y1"))).alias("tall")).first()
    if not e["n"]:
        return rows.limit(0)
    band = (e["hi"] - e["lo"]) / MAX_BUCKETS or 1.0
    # An edge lies in at most 2 + tall / band bands; boxes that leave the polygons' range of y are outside.
    at = lambda c: F.floor((c - F.lit(e["lo"])) / F.lit(band))
    keyed = edges.select("*", F.explode(F.sequence(at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))).alias("band"))
    keyed = broadcast_if_bounded(keyed.withColumnsRenamed({"x1": "ex1", "y1": "ey1", "x2": "ex2", "y2": "ey2"}), int(2 * e["n"] + e["tall"] / band))
    b = boxes.select(*[F.col(c).alias(k) for c, k in zip(box, ("bx0", "by0", "bx1", "by1"))])
    b = b.where((F.col("by0") >= e["lo"]) & (F.col("by1") <= e["hi"])).withColumns(
        {"cx": (F.col("bx0") + F.col("bx1")) / 2, "cy": (F.col("by0") + F.col("by1")) / 2})
    met = b.select("*", F.explode(F.sequence(at(F.col("by0")), at(F.col("by1")))).alias("band")).join(keyed, "band")
    # Side of the edge's line on which a corner lies.
    side = lambda x, y: (F.col("ex2") - F.col("ex1")) * (F.col(y) - F.col("ey1")) - (F.col("ey2") - F.col("ey1")) * (F.col(x) - F.col("ex1"))
    corners = [side(x, y) for x in ("bx0", "bx1") for y in ("by0", "by1")]
    apart = ((F.greatest("ex1", "ex2") <= F.col("bx0")) | (F.least("ex1", "ex2") >= F.col("bx1"))
             | (F.greatest("ey1", "ey2") <= F.col("by0")) | (F.least("ey1", "ey2") >= F.col("by1"))
             | (F.least(*corners) >= 0) | (F.greatest(*corners) <= 0))
    right = F.col("cx") < F.try_divide((F.col("ex2") - F.col("ex1")) * (F.col("cy") - F.col("ey1")), F.col("ey2") - F.col("ey1")) + F.col("ex1")
    crosses = (F.col("band") == at(F.col("cy"))) & ((F.col("ey1") > F.col("cy")) != (F.col("ey2") > F.col("cy"))) & right
    good = met.groupBy("bx0", "by0", "bx1", "by1", "poly_id").agg(
        F.max((~apart).cast("int")).alias("enters"), F.sum(F.coalesce(crosses, F.lit(False)).cast("int")).alias("n"))
    good = good.where((F.col("enters") == 0) & (F.col("n") % 2 == 1)).select(*[F.col(k).alias(c) for c, k in zip(box, ("bx0", "by0", "bx1", "by1"))])
    return rows.join(good.distinct(), list(box), "left_semi").select(*rows.columns)


def tiles_intersecting(tiles: DataFrame, edges: DataFrame, tile_size: int) -> DataFrame:
    """Tiles (col,row) by the mask's rule: a tile is kept when any of its
    cells has its centre inside.  Tiles that a polygon touches otherwise
    are kept by ``tiles_touched`` only.

    Each pixel-row span becomes a range of tile columns, see ``_in_ranges``."""
    spans = row_spans(edges)
    n = tile_size
    lo_gx = F.ceil(F.col("lo") - F.lit(0.5))
    hi_gx = F.ceil(F.col("hi") - F.lit(0.5)) - 1
    ranges = (spans.where(hi_gx >= lo_gx)
              .select(F.floor(F.col("gy") / n).alias("row"), F.floor(lo_gx / n).alias("c0"),
                      F.floor(hi_gx / n).alias("c1")))
    return _in_ranges(tiles, ranges, _tile_key_bound(edges, n))


def tiles_touched(tiles: DataFrame, edges: DataFrame, tile_size: int) -> DataFrame:
    """Tiles (col,row) whose closed box meets a polygon (C5): its border
    (also in a single point) or its inside.

    Each edge is cut at the tile rows it meets; a cut piece gives the range
    of tile columns between its ends.  A tile that no edge meets lies wholly
    inside or outside, so the row spans at tile grain add the inside ones."""
    n = float(tile_size)
    e = edges.select(*[(F.col(c) / n).alias(c) for c in ("x1", "y1", "x2", "y2")], "poly_id")
    ymin, ymax, xmin, xmax = F.least("y1", "y2"), F.greatest("y1", "y2"), F.least("x1", "x2"), F.greatest("x1", "x2")
    rows = e.select("*", F.explode(F.sequence(F.ceil(ymin) - 1, F.floor(ymax))).alias("row"))

    def x_at(y: Column) -> Column:
        cut = F.try_divide((F.col("x2") - F.col("x1")) * (y - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")
        return F.when(y == F.col("y1"), F.col("x1")).when(y == F.col("y2"), F.col("x2")).otherwise(F.least(F.greatest(cut, xmin), xmax))

    flat = F.col("y1") == F.col("y2")
    a, b = x_at(F.greatest(ymin, F.col("row").cast("double"))), x_at(F.least(ymax, F.col("row") + F.lit(1.0)))
    border = rows.select("row", F.when(flat, xmin).otherwise(F.least(a, b)).alias("lo"), F.when(flat, xmax).otherwise(F.greatest(a, b)).alias("hi"))
    border = border.select("row", (F.ceil("lo") - 1).alias("c0"), F.floor("hi").alias("c1"))
    c0, c1 = F.ceil(F.col("lo") - F.lit(0.5)), F.ceil(F.col("hi") - F.lit(0.5)) - 1
    inside = row_spans(e).where(c1 >= c0).select(F.col("gy").alias("row"), c0.alias("c0"), c1.alias("c1"))
    return _in_ranges(tiles, border.unionByName(inside), _tile_key_bound(edges, tile_size, 1))


def _in_ranges(tiles: DataFrame, ranges: DataFrame, bound: int) -> DataFrame:
    """Tiles within any of the ranges ``(row, c0, c1)`` of tile columns.

    The ranges of one tile row (at most n pixel rows x spans per row, a
    bounded window) are merged into disjoint intervals by a running max, and
    only the merged intervals are exploded — so the key table has one row per
    touched tile, never one per (pixel row, tile).  The keys are then
    semi-joined."""
    ranges = ranges.distinct()
    w = Window.partitionBy("row").orderBy("c0", "c1")
    prev_max = F.max("c1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.withColumn("new", F.when(prev_max.isNull() | (F.col("c0") > prev_max + 1), 1).otherwise(0))
    grouped = starts.withColumn("grp", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = grouped.groupBy("row", "grp").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
    keys = merged.select("row", F.explode(F.sequence("c0", "c1")).alias("col"))
    return tiles.join(broadcast_if_bounded(keys, bound), ["col", "row"], "left_semi")


def _tile_key_bound(edges: DataFrame, n: int, more: int = 0) -> int:
    """Upper bound on tiles touched: tiles under each polygon's bounding box
    (``more``: and so many before it)."""
    b = polygon_bounds(edges).agg(
        F.sum((F.floor(F.col("xmax") / n) - F.floor(F.col("xmin") / n) + 1 + more)
              * (F.floor(F.col("ymax") / n) - F.floor(F.col("ymin") / n) + 1 + more)).alias("b")).first()
    return int(b["b"] or 0)
