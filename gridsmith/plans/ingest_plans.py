"""Scene list and band ingest queries (F4 scenes, F5 band rows)."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from gridsmith.functions.grid import ntz, window_extent
from gridsmith.operators import ingest as ig
from gridsmith.operators import polygon
from gridsmith.operators.geometry import footprint_edges, lonlat_to_mercator
from gridsmith.plans.oracle import with_ctes
from gridsmith.plans.registry import r6, register
from gridsmith.sources import fixtures as fx

# The imagery bounds rectangle (lon/lat degrees).
BOUNDS = (-130.60546875, 21.94304553343818, -63.54492187500001, 51.72702815704774)
SEARCH_FROM, SEARCH_TO = dt.datetime(1998, 1, 1), dt.datetime(1998, 12, 1)
SEARCH_BBOX = (-110.0, 30.0, -80.0, 45.0)
MAX_CLOUD = 10
PAGE_SIZE = 10

NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in ig.LANDSAT8_BAND_NAMES) + "]"
DESIRED_SQL = "desired as (select * from (values " + ", ".join(
    f"('{k}', {v})" for k, v in ig.DESIRED_BANDS.items()) + ") t(band_name, band_num))"
LON = "lon10 / 10.0::double"
LAT = "lat10 / 10.0::double"


def scenes(spark, sf):
    return fx.scenes(spark, sf)


def band_rows(spark, sf):
    return fx.band_rows(spark, sf)


def _lon():
    return F.col("lon10") / F.lit(10.0)


def _lat():
    return F.col("lat10") / F.lit(10.0)


@register("filter_month", with_ctes("select * from scenes where month(time) = 6", "scenes"))
def q_filter_month(spark, sf):
    return scenes(spark, sf).where(F.month("time") == 6)


@register("take_n", with_ctes("select * from scenes order by time, scene_id limit 50", "scenes"))
def q_take_n(spark, sf):
    """First 5 bands x 10 scenes = 50 rows in a stable order."""
    return scenes(spark, sf).orderBy("time", "scene_id").limit(5 * 10)


@register("pick_kth", with_ctes("select * from scenes order by time, scene_id limit 1 offset 5", "scenes"))
def q_pick_kth(spark, sf):
    """results[5]: the sixth row in a stable order."""
    return scenes(spark, sf).orderBy("time", "scene_id").offset(5).limit(1)


@register("filter_extent_within", with_ctes(
    f"""select * from scenes where {LON} >= {BOUNDS[0]}::double and {LON} + 2.0::double <= {BOUNDS[2]}::double
        and {LAT} >= {BOUNDS[1]}::double and {LAT} + 2.0::double <= {BOUNDS[3]}::double""", "scenes"))
def q_filter_extent_within(spark, sf):
    """Scenes whose footprint lies inside the bounds rectangle."""
    x0, y0, x1, y1 = BOUNDS
    lon, lat = _lon(), _lat()
    return scenes(spark, sf).where((lon >= F.lit(x0)) & (lon + F.lit(2.0) <= F.lit(x1))
                                   & (lat >= F.lit(y0)) & (lat + F.lit(2.0) <= F.lit(y1)))


@register("skip_missing_sources", with_ctes(
    "select scene_id, path from scenes where path in (select path from scenes where present)", "scenes"))
def q_skip_missing_sources(spark, sf):
    """Listed sources whose file exists: a semi join with the file listing."""
    s = scenes(spark, sf)
    listing = s.where("present").select("path")
    return s.select("scene_id", "path").join(listing, "path", "left_semi")


COMPLETE = "complete as (select scene from band_rows group by scene having count(*) = 5)"


@register("complete_band_sets", with_ctes(
    "select * from band_rows where scene in (select scene from complete)", "band_rows", extra=[COMPLETE]))
def q_complete_band_sets(spark, sf):
    return ig.complete_band_sets(band_rows(spark, sf), "scene", 5)


@register("band_whitelist", with_ctes(
    f"""select scene, b.band_name, d.band_num, v
        from (select *, {NAMES_SQL}[band] as band_name from band_rows) b join desired d using (band_name)""",
    "band_rows", extra=[DESIRED_SQL]))
def q_band_whitelist(spark, sf):
    rows = band_rows(spark, sf).select("scene", ig.band_name(F.col("band")).alias("band_name"), "v")
    return ig.band_whitelist(rows, ig.desired_bands(spark)).select("scene", "band_name", "band_num", "v")


@register("stack_bands", with_ctes(
    """select scene, list(band order by band, v) as bands, list(v order by band, v) as values
       from band_rows where scene in (select scene from complete) group by scene""", "band_rows", extra=[COMPLETE]))
def q_stack_bands(spark, sf):
    return ig.stack_bands(band_rows(spark, sf))


@register("stack_bands_pivot", with_ctes(
    "select scene, " + ", ".join(f"max(case when band = {b} then v end) as b{b}" for b in range(1, 6))
    + " from band_rows where scene in (select scene from complete) group by scene", "band_rows", extra=[COMPLETE]))
def q_stack_bands_pivot(spark, sf):
    return ig.stack_bands_pivot(band_rows(spark, sf))


@register("stack_shape_check", with_ctes(
    """select scene, count(*) as n_rows, count(distinct band) as n_bands from band_rows
       group by scene having count(*) <> count(distinct band)""", "band_rows"))
def q_stack_shape_check(spark, sf):
    return ig.shape_check(band_rows(spark, sf))


@register("stack_array_shapes", with_ctes(
    """select scene, count(*) as n_rows, list_sort(list(distinct concat('2x', 2 + v % 3))) as shapes
       from band_rows group by scene having count(distinct v % 3) > 1""", "band_rows"))
def q_stack_array_shapes(spark, sf):
    """Scenes whose band arrays (2 cells wide, 2 to 4 lines by the band's value) cannot be stacked."""
    rows = band_rows(spark, sf).select("scene", F.lit(2).alias("width"), F.array_repeat("v", ((2 + F.col("v") % 3) * 2).cast("int")).alias("cells"))
    return ig.array_shape_check(rows)


@register("scene_count", with_ctes(
    "select count(*) as n, count(*) filter (where present) as n_present from scenes", "scenes"))
def q_scene_count(spark, sf):
    return scenes(spark, sf).agg(F.count("*").alias("n"), F.count_if("present").alias("n_present"))


@register("scenes_by_weekday", with_ctes("select cast(isodow(time) as integer) as dow, count(*) as n from scenes group by 1", "scenes"))
def q_scenes_by_weekday(spark, sf):
    """One job over all weekday groups (the reference loops on the driver)."""
    return scenes(spark, sf).groupBy(ig.iso_weekday(F.col("time")).alias("dow")).agg(F.count("*").alias("n"))


@register("lonlat_to_mercator", with_ctes(
    f"""select scene_id, round(6378137.0::double * radians({LON}), 3) as x,
              round(6378137.0::double * ln(tan({math.pi / 4!r} + radians({LAT}) / 2)), 3) as y from scenes""",
    "scenes"))
def q_lonlat_to_mercator(spark, sf):
    x, y = lonlat_to_mercator(_lon(), _lat())
    return scenes(spark, sf).select("scene_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


WINDOWS = """windows as (
  select scene_id, lon10, lat10, col_off, row_off, least(512, n_cols - col_off) as width,
         least(512, n_rows - row_off) as height, n_cols, n_rows
  from scenes, unnest(range(0, n_cols, 512)) a(col_off), unnest(range(0, n_rows, 512)) b(row_off))"""


@register("list_windows", with_ctes(
    "select scene_id, col_off, row_off, width, height, n_cols, n_rows from windows", "scenes", extra=[WINDOWS]))
def q_list_windows(spark, sf):
    return ig.list_windows(scenes(spark, sf), keep=("scene_id",))


@register("buffered_windows", with_ctes(
    """select scene_id, col_off, row_off, width, height, n_cols, n_rows,
              greatest(0, col_off - 3) as bcol0, greatest(0, row_off - 3) as brow0,
              least(n_cols - 1, col_off + width - 1 + 3) as bcol1, least(n_rows - 1, row_off + height - 1 + 3) as brow1
       from windows""", "scenes", extra=[WINDOWS]))
def q_buffered_windows(spark, sf):
    return ig.buffer_windows(ig.list_windows(scenes(spark, sf), keep=("scene_id",)))


@register("window_extent", with_ctes(
    f"""select scene_id, col_off, row_off,
          round({LON} + col_off * (2.0::double / n_cols), 6) as xmin,
          round({LON} + col_off * (2.0::double / n_cols) + width * (2.0::double / n_cols), 6) as xmax,
          round({LAT} + 2.0::double - row_off * (2.0::double / n_rows), 6) as ymax,
          round({LAT} + 2.0::double - row_off * (2.0::double / n_rows) - height * (2.0::double / n_rows), 6) as ymin
        from windows""", "scenes", extra=[WINDOWS]))
def q_window_extent(spark, sf):
    s = scenes(spark, sf).select("scene_id", "lon10", "lat10", "n_cols", "n_rows")
    w = ig.list_windows(s, keep=("scene_id", "lon10", "lat10"))
    xres = F.lit(2.0) / F.col("n_cols")
    yres = F.lit(2.0) / F.col("n_rows")
    e = window_extent(_lon(), _lat() + F.lit(2.0), xres, yres, F.col("col_off"), F.col("row_off"),
                      F.col("width"), F.col("height"))
    return w.select("scene_id", "col_off", "row_off", *[F.round(e[k], 6).alias(k) for k in ("xmin", "xmax", "ymax", "ymin")])


@register("split_uri", with_ctes(
    r"""select scene_id, regexp_extract(path, '^[a-zA-Z0-9]+://([^/]+)', 1) as bucket,
              coalesce(regexp_extract(path, '^[a-zA-Z0-9]+://[^/]+/(.*)$', 1), '') as key from scenes""", "scenes"))
def q_split_uri(spark, sf):
    b, k = ig.split_uri(F.col("path"))
    return scenes(spark, sf).select("scene_id", b.alias("bucket"), k.alias("key"))


@register("time_parts", with_ctes(
    """select scene_id, cast(month(time) as integer) as month, cast(isodow(time) as integer) as dow, epoch_ms(time) as epoch_ms,
              strftime(time, '%Y-%m-%dT%H:%M:%S') as iso from scenes""", "scenes"))
def q_time_parts(spark, sf):
    t = F.col("time")
    return scenes(spark, sf).select("scene_id", F.month(t).alias("month"), ig.iso_weekday(t).alias("dow"),
                                    ig.epoch_millis_ntz(t).alias("epoch_ms"),
                                    F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@register("explode_images", with_ctes(
    f"""select s.time, s.scene_id, d.band_num, replace(s.path, '_B1.TIF', '_B' || r.k || '.TIF') as uri
        from scenes s, range(1, {len(ig.LANDSAT8_BAND_NAMES) + 1}) r(k), desired d
        where d.band_name = {NAMES_SQL}[r.k]""", "scenes", extra=[DESIRED_SQL]))
def q_explode_images(spark, sf):
    """Nested scene records (one image per band file, each with a band list)
    flattened to one row per wanted image (H29 + B11)."""
    s = scenes(spark, sf)
    images = F.array(*[F.struct(F.regexp_replace("path", "_B1.TIF", f"_B{k}.TIF").alias("sourceUri"),
                                F.array(F.struct(F.lit(name).alias("name"))).alias("bands"))
                       for k, name in enumerate(ig.LANDSAT8_BAND_NAMES, start=1)])
    rec = s.select("time", "scene_id", images.alias("images"))
    flat = rec.select("time", "scene_id", F.explode("images").alias("image"))
    rows = flat.select("time", "scene_id", F.col("image.sourceUri").alias("uri"),
                       F.element_at("image.bands", 1)["name"].alias("band_name"))
    return ig.band_whitelist(rows, ig.desired_bands(spark)).select("time", "scene_id", "band_num", "uri")


SEARCH = f"""time between '{SEARCH_FROM}' and '{SEARCH_TO}' and cloud <= {MAX_CLOUD}
  and {LON} < {SEARCH_BBOX[2]}::double and {LON} + 2.0::double > {SEARCH_BBOX[0]}::double
  and {LAT} < {SEARCH_BBOX[3]}::double and {LAT} + 2.0::double > {SEARCH_BBOX[1]}::double"""


def scene_search(spark, sf):
    """Date range + bbox overlap + max cloud cover."""
    lon, lat = _lon(), _lat()
    return ig.search_scenes(scenes(spark, sf), F.col("time"), (SEARCH_FROM, SEARCH_TO), (lon, lat, lon + F.lit(2.0), lat + F.lit(2.0)),
                            SEARCH_BBOX, F.col("cloud"), MAX_CLOUD)


@register("scene_search", with_ctes(f"select * from scenes where {SEARCH}", "scenes"))
def q_scene_search(spark, sf):
    return scene_search(spark, sf)


@register("scene_search_page", with_ctes(
    f"select * from scenes where {SEARCH} order by time, scene_id limit {PAGE_SIZE} offset {PAGE_SIZE}", "scenes"))
def q_scene_search_page(spark, sf):
    """Second page of the search in a stable order."""
    return ig.result_page(scene_search(spark, sf), ["time", "scene_id"], 1, PAGE_SIZE)


@register("first_matching_image", with_ctes(
    """select time, scene_id, case when cloud // 9 + 1 <= 11 and cloud <> 99 then cast(cloud // 9 + 1 as integer) end as number,
              case when cloud // 9 + 1 <= 11 and cloud <> 99 then replace(path, '_B1.TIF', concat('_B', cast(cloud // 9 + 1 as varchar), '.TIF')) end as uri
       from scenes""", "scenes"))
def q_first_matching_image(spark, sf):
    """Of each nested scene record the first image whose band number times nine is over the scene's cloud cover, null
    where no image is (H29: first array element that meets a predicate)."""
    images = F.array(*[F.struct(F.lit(k).alias("number"), F.regexp_replace("path", "_B1.TIF", f"_B{k}.TIF").alias("uri"))
                       for k in range(1, 12)])
    found = ig.first_match(images, lambda i: i["number"] * 9 > F.col("cloud"))
    return scenes(spark, sf).withColumn("found", found).select("time", "scene_id", "found.number", "found.uri")


# Bounds with a bay, a hole and a second part, as rings in tenths of a degree, in which footprints have whole numbers.
BOUNDS_RINGS = [[(-1300.0, 220.0), (-640.0, 240.0), (-700.0, 510.0), (-980.0, 365.0), (-1270.0, 500.0)],
                [(-1180.0, 280.0), (-1060.0, 280.0), (-1120.0, 350.0)],
                [(-1040.0, 440.0), (-920.0, 440.0), (-920.0, 515.0), (-1040.0, 515.0)]]
BOUNDS_EDGES = [(1, *p, *q) for ring in BOUNDS_RINGS for p, q in zip(ring, ring[1:] + ring[:1])]
BOUNDS_SQL = "bounds as (select poly_id::integer as poly_id, x1::double as x1, y1::double as y1, x2::double as x2, y2::double as y2 from (values " \
    + ", ".join(map(str, BOUNDS_EDGES)) + ") t(poly_id, x1, y1, x2, y2))"
# Even-odd centre, and no edge that has a point strictly inside the box: the edge is clipped to it by its parameter.
BOXES_SQL = """boxes as (select distinct lon10, lat10, lon10::double as a, lat10::double as b from scenes),
clipped as (
  select lon10, lat10, e.*, a, b,
    case when x1 = x2 then case when x1 > a and x1 < a + 20 then 0.0::double else 2.0::double end else least((a - x1) / (x2 - x1), (a + 20 - x1) / (x2 - x1)) end as tx0,
    case when x1 = x2 then 1.0::double else greatest((a - x1) / (x2 - x1), (a + 20 - x1) / (x2 - x1)) end as tx1,
    case when y1 = y2 then case when y1 > b and y1 < b + 20 then 0.0::double else 2.0::double end else least((b - y1) / (y2 - y1), (b + 20 - y1) / (y2 - y1)) end as ty0,
    case when y1 = y2 then 1.0::double else greatest((b - y1) / (y2 - y1), (b + 20 - y1) / (y2 - y1)) end as ty1
  from boxes, bounds e),
within as (
  select lon10, lat10 from clipped group by lon10, lat10, poly_id
  having sum(case when greatest(tx0, ty0, 0) + 1e-12 < least(tx1, ty1, 1) then 1 else 0 end) = 0
     and sum(case when (y1 > b + 10) <> (y2 > b + 10) and a + 10 < (x2 - x1) * (b + 10 - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2 = 1)"""


@register("filter_extent_polygon", with_ctes(
    "select s.* from scenes s where (lon10, lat10) in (select (lon10, lat10) from within)", "scenes", extra=[BOUNDS_SQL, BOXES_SQL]))
def q_filter_extent_polygon(spark, sf):
    """Scenes whose footprint lies inside bounds with a bay, a hole and two parts."""
    bounds = spark.createDataFrame(BOUNDS_EDGES, "poly_id int, x1 double, y1 double, x2 double, y2 double")
    s = scenes(spark, sf)
    lon, lat = F.col("lon10").cast("double"), F.col("lat10").cast("double")
    boxed = s.withColumns({"xmin": lon, "ymin": lat, "xmax": lon + F.lit(20.0), "ymax": lat + F.lit(20.0)})
    return polygon.extents_within(boxed, bounds).select(*s.columns)


FOOTPRINTS = """footprint_edges as (
  select scene_id as poly_id, a + dx1 * 2.0 as x1, b + dy1 * 2.0 as y1, a + dx2 * 2.0 as x2, b + dy2 * 2.0 as y2
  from (select scene_id, lon10 / 10.0::double as a, lat10 / 10.0::double as b from scenes) s,
       (values (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)) r(dx1, dy1, dx2, dy2))"""


@register("polygon_centroid", with_ctes(
    """select poly_id, round(abs(sum(x1 * y2 - x2 * y1) / 2), 6) as area,
              round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (6 * (sum(x1 * y2 - x2 * y1) / 2)), 6) as cx,
              round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (6 * (sum(x1 * y2 - x2 * y1) / 2)), 6) as cy
       from footprint_edges group by poly_id""", "scenes", extra=[FOOTPRINTS]))
def q_polygon_centroid(spark, sf):
    c = polygon.polygon_centroid(footprint_edges(scenes(spark, sf)))
    return c.select("poly_id", r6("area"), r6("cx"), r6("cy"))


@register("raster_windows_read", with_ctes(
    "select gx // 16 as wx, gy // 16 as wy, count(*) as n, min(elev) as min, max(elev) as max from dem group by all",
    "dem"))
def q_raster_windows_read(spark, sf):
    """Read a raster as windows of at most 16 x 16 cells (A5)."""
    d = fx.dem(spark, sf)
    return (d.groupBy(F.floor(F.col("gx") / 16).alias("wx"), F.floor(F.col("gy") / 16).alias("wy"))
            .agg(F.count("*").alias("n"), F.min("elev").alias("min"), F.max("elev").alias("max")))


INGEST_ZOOM = 7
INGEST_MONTH = 6


def ingest_plan(spark, sf, month: int = INGEST_MONTH, zoom: int = INGEST_ZOOM):
    """The scene-ingest job's planning half, end to end:
    scenes of one month inside the bounds -> wanted band images -> 512-cell
    windows with a 3-cell halo -> window extents -> layout keys.  Output: the
    distinct (scene, band, tile) triples each band image contributes to — the
    work list a reader would fetch.  One DataFrame job; no driver loop over
    weekday groups, no per-scene collect."""
    from gridsmith.operators import tiles as tl
    x0, y0, x1, y1 = BOUNDS
    lon, lat = _lon(), _lat()
    s = scenes(spark, sf).where((F.month("time") == month) & (lon >= F.lit(x0)) & (lon + F.lit(2.0) <= F.lit(x1))
                                & (lat >= F.lit(y0)) & (lat + F.lit(2.0) <= F.lit(y1)))
    names = F.array(*[F.lit(n) for n in ig.LANDSAT8_BAND_NAMES])
    imgs = s.select("scene_id", "lon10", "lat10", "n_cols", "n_rows",
                    F.posexplode(names).alias("pos", "band_name"))
    imgs = ig.band_whitelist(imgs, ig.desired_bands(spark))
    w = ig.buffer_windows(ig.list_windows(imgs, keep=("scene_id", "band_num", "lon10", "lat10")))
    xres, yres = F.lit(2.0) / F.col("n_cols"), F.lit(2.0) / F.col("n_rows")
    xmin = _lon() + F.col("bcol0") * xres
    xmax = _lon() + (F.col("bcol1") + 1) * xres
    ymax = _lat() + F.lit(2.0) - F.col("brow0") * yres
    ymin = _lat() + F.lit(2.0) - (F.col("brow1") + 1) * yres
    n = float(2 ** zoom)
    half = math.pi * 6378137.0
    col = lambda x: F.floor((x + F.lit(180.0)) / F.lit(360.0) * F.lit(n))
    row = lambda y: F.floor((F.lit(half) - lonlat_to_mercator(F.lit(0.0), y)[1]) / F.lit(2 * half / n))
    ext = w.select("scene_id", "band_num", col(xmin).alias("c0"), col(xmax).alias("c1"),
                   row(ymax).alias("r0"), row(ymin).alias("r1"))
    keys = tl.extent_to_keys(ext, F.col("c0"), F.col("c1"), F.col("r0"), F.col("r1"), keep=("scene_id", "band_num"))
    return keys.distinct()


def _row_sql(y: str) -> str:
    half = math.pi * 6378137.0
    return (f"floor(({half!r}::double - 6378137.0::double * ln(tan({math.pi / 4!r} + radians({y}) / 2))) "
            f"/ {2 * half / 2 ** INGEST_ZOOM!r}::double)")


def _col_sql(x: str) -> str:
    return f"floor(({x} + 180.0::double) / 360.0::double * {float(2 ** INGEST_ZOOM)!r}::double)"


@register("scene_ingest_plan", with_ctes(
    f"""select distinct scene_id, band_num, col, row from (
          select scene_id, band_num,
            {_col_sql(f'{LON} + bcol0 * (2.0::double / n_cols)')} as c0,
            {_col_sql(f'{LON} + (bcol1 + 1) * (2.0::double / n_cols)')} as c1,
            {_row_sql(f'{LAT} + 2.0::double - brow0 * (2.0::double / n_rows)')} as r0,
            {_row_sql(f'{LAT} + 2.0::double - (brow1 + 1) * (2.0::double / n_rows)')} as r1
          from (select i.*, greatest(0, col_off - 3) as bcol0, greatest(0, row_off - 3) as brow0,
                       least(n_cols - 1, col_off + least(512, n_cols - col_off) - 1 + 3) as bcol1,
                       least(n_rows - 1, row_off + least(512, n_rows - row_off) - 1 + 3) as brow1
                from (select s.scene_id, s.lon10, s.lat10, s.n_cols, s.n_rows, d.band_num
                      from scenes s, range(1, {len(ig.LANDSAT8_BAND_NAMES) + 1}) r(k), desired d
                      where d.band_name = {NAMES_SQL}[r.k] and month(s.time) = {INGEST_MONTH}
                        and {LON} >= {BOUNDS[0]}::double and {LON} + 2.0::double <= {BOUNDS[2]}::double
                        and {LAT} >= {BOUNDS[1]}::double and {LAT} + 2.0::double <= {BOUNDS[3]}::double) i,
                     unnest(range(0, n_cols, 512)) a(col_off), unnest(range(0, n_rows, 512)) b(row_off)) w) e,
          unnest(range(c0::bigint, c1::bigint + 1)) u(col), unnest(range(r0::bigint, r1::bigint + 1)) v(row)""",
    "scenes", extra=[DESIRED_SQL]))
def q_scene_ingest_plan(spark, sf):
    return ingest_plan(spark, sf)
