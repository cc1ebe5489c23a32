"""Colour and composite queries.  The DuckDB oracles restate every colour
rule in plain SQL, one CTE per stage."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridsmith.functions import color as co
from gridsmith.functions.indices import cloud_masked_index
from gridsmith.operators import focal, mosaic, render
from gridsmith.plans.focal_plans import ALTITUDE, AZIMUTH, CELL_SIZE, GRAD, Z_FACTOR
from gridsmith.plans.imagery import MASKED, NDVI
from gridsmith.plans.mosaics import BRIGHT, _ranked, masked
from gridsmith.plans.oracle import with_ctes
from gridsmith.plans.registry import r6, register
from gridsmith.sources import fixtures as fx

D = "::double"


def _lit(x: float) -> str:
    return f"{float(x)!r}{D}"


def s_uint8(x: str) -> str:
    return f"cast(least(greatest(case when ({x}) >= 0 then floor({x}) else ceil({x}) end, 0), 255) as integer)"


def s_stretch(v: str) -> str:
    c = f"(case when {v} <> 0 then least(greatest({v}, {co.STRETCH_MIN}), {co.STRETCH_MAX}) else {v} end)"
    return s_uint8(f"({c} - {co.STRETCH_MIN}) * 255 / {co.STRETCH_MAX - co.STRETCH_MIN}")


def s_hsv_cols(r: str, g: str, b: str, p: str) -> str:
    R, G, B = f"{r}{D}", f"{g}{D}", f"{b}{D}"
    mx, mn = f"greatest({R}, {G}, {B})", f"least({R}, {G}, {B})"
    d = f"(case when {mn} = {mx} then 1.0{D} else {mx} - {mn} end)"
    rc, gc, bc = (f"(({mx} - {x}) / {d})" for x in (R, G, B))
    h = (f"(case when {mx} = {R} then {bc} - {gc} when {mx} = {G} then 2.0{D} + {rc} - {bc} "
         f"when {mx} = {B} then 4.0{D} + {gc} - {rc} else 0.0{D} end)")
    h6 = f"({h} / 6.0{D})"
    return f"{h6} - floor({h6}) as {p}h, ({mx} - {mn}) / greatest(1.0{D}, {mx}) as {p}s, {mx} as {p}v"


def s_rgb_from_hsv(h: str, s: str, v: str, out=("r", "g", "b")) -> str:
    i = f"least(floor({h} * 6), 5)"
    f = f"({h} * 6 - {i})"
    p, q, t = f"({v} * (1.0{D} - {s}))", f"({v} * (1.0{D} - {s} * {f}))", f"({v} * (1.0{D} - {s} * (1.0{D} - {f})))"

    def pick(*xs):
        return "(case " + " ".join(f"when {i} = {k} then {x}" for k, x in enumerate(xs)) + " end)"

    return ", ".join(f"{pick(*xs)} as {o}" for xs, o in
                     zip(((v, q, p, p, t, v), (t, v, v, q, p, p), (p, p, t, v, v, q)), out))


def s_gamma(x: str, g: float) -> str:
    return f"pow({x}, {_lit(1.0 / g)})"


def s_sigmoid(x: str, c: float, b: float) -> str:
    lo = 1.0 / (1.0 + math.exp(c * b))
    hi = 1.0 / (1.0 + math.exp(c * (b - 1.0)))
    return f"((1.0{D} / (1.0{D} + exp({_lit(c)} * ({_lit(b)} - {x}))) - {_lit(lo)}) / {_lit(hi - lo)})"


def s_unit(x: str) -> str:
    return f"(greatest({x}{D}, 0.0{D}) / 256)"


def s_sat_cols(r: str, g: str, b: str, p: float, out) -> str:
    mx, mn = f"greatest({r}, {g}, {b})", f"least({r}, {g}, {b})"
    d = f"(case when {mn} = {mx} then 1.0{D} else {mx} - {mn} end)"
    rc, gc, bc = (f"(({mx} - {x}) / {d})" for x in (r, g, b))
    h0 = (f"((case when {mx} = {r} then {bc} - {gc} when {mx} = {g} then 2.0{D} + {rc} - {bc} "
          f"else 4.0{D} + {gc} - {rc} end) / 6)")
    h = f"({h0} - floor({h0}))"
    s = f"(case when {mx} > 0 then ({mx} - {mn}) / (case when {mx} > 0 then {mx} else 1.0{D} end) else 0.0{D} end)"
    s2 = f"least({s} * {_lit(p)}, 1.0{D})"
    return s_rgb_from_hsv(h, s2, mx, out)


HS = (f"hs as (select gx, gy, 255.0{D} * greatest(0.0{D}, ({math.sin(math.radians(ALTITUDE))!r} "
      f"- dx * {math.sin(math.radians(AZIMUTH)) * math.cos(math.radians(ALTITUDE))!r} "
      f"+ dy * {math.cos(math.radians(AZIMUTH)) * math.cos(math.radians(ALTITUDE))!r}) "
      f"/ sqrt(1.0{D} + dx * dx + dy * dy)) as hillshade from grad)")
MOS = "mos as (" + _ranked(f"{BRIGHT} desc, instant desc") + ")"
BASE = "base as (select m.*, h.hillshade, c.nlcd from mos m join hs h using (gx, gy) join classes c using (gx, gy))"
RGBA = (f"rgba as (select *, {s_stretch('red')} as r, {s_stretch('green')} as g, {s_stretch('blue')} as b, "
        "case when blue = 0 and green = 0 and red = 0 then 0 else 255 end as a from base)")
SHADED = [f"hsv0 as (select *, {s_hsv_cols('r', 'g', 'b', '_')} from rgba)",
          "hsv1 as (select * replace ((hillshade * 256 / 200 * 4 + _v) / 5 as _v) from hsv0)",
          f"shaded as (select *, {s_rgb_from_hsv('_h', '_s', '_v', ('sr', 'sg', 'sb'))} from hsv1)"]
COMPOSITE_CTES = ("landsat", "classes", "dem")
COMPOSITE_EXTRA = [MASKED, GRAD, HS, MOS, BASE, RGBA]


def _composite(spark, sf):
    mos = mosaic.mosaic(masked(spark, sf), "bright")
    classes = fx.classes(spark, sf).select("gx", "gy", "nlcd")
    # The composite lies where the static layer is: only the elevation there, with its neighbours, is shaded.
    dem = render.near_cells(fx.dem(spark, sf), classes)
    hs = focal.hillshade(dem, "elev", AZIMUTH, ALTITUDE, Z_FACTOR, CELL_SIZE)
    return render.composite_join(mos, hs, classes)


@register("composite_join", with_ctes(
    "select gx, gy, red, green, blue, round(hillshade, 6) as hillshade, nlcd from base",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA[:-1]))
def q_composite_join(spark, sf):
    return _composite(spark, sf).select("gx", "gy", "red", "green", "blue", r6("hillshade"), "nlcd")


@register("stretch_rgb", with_ctes(
    f"""select gx, gy, {s_stretch('red')} as r, {s_stretch('green')} as g, {s_stretch('blue')} as b,
        case when blue = 0 and green = 0 and red = 0 then 0 else 255 end as a from mos""",
    "landsat", extra=[MASKED, MOS]))
def q_stretch_rgb(spark, sf):
    m = mosaic.mosaic(masked(spark, sf), "bright")
    return render.landsat_rgba(m).select("gx", "gy", "r", "g", "b", "a")


@register("colormap_le", with_ctes(
    "select instant, gx, gy, case " + " ".join(f"when ndvi <= {_lit(b)} then {c}" for b, c in co.NDVI_BREAKS)
    + f" else {co.TRANSPARENT} end::bigint as rgba from ndvi_cells", "landsat", extra=[MASKED, NDVI]))
def q_colormap_le(spark, sf):
    l = fx.landsat(spark, sf)
    return l.select("instant", "gx", "gy", co.colormap_le(cloud_masked_index(l, "ndvi")).alias("rgba"))


@register("colormap_le_ndwi", with_ctes(
    "select instant, gx, gy, case " + " ".join(f"when ndwi <= {_lit(b)} then {c}" for b, c in co.NDWI_BREAKS)
    + f" else {co.TRANSPARENT} end::bigint as rgba from (select instant, gx, gy, "
    f"(green{D} - nir{D}) / nullif(green{D} + nir{D}, 0) as ndwi from masked) t", "landsat", extra=[MASKED]))
def q_colormap_le_ndwi(spark, sf):
    l = fx.landsat(spark, sf)
    return l.select("instant", "gx", "gy", co.colormap_le(cloud_masked_index(l, "ndwi"), co.NDWI_BREAKS).alias("rgba"))


EXACT = "ex as (select c.gx, c.gy, c.value, coalesce(l.rgba, 0) as rgba from classes c left join crop_labels l on l.code = c.value)"


@register("colormap_exact", with_ctes("select gx, gy, value, rgba from ex", "classes", "crop_labels", extra=[EXACT]))
def q_colormap_exact(spark, sf):
    c = fx.classes(spark, sf).select("gx", "gy", "value")
    return co.colormap_exact(c, "value", fx.crop_labels(spark))


@register("rgba_unpack", with_ctes(
    "select gx, gy, (rgba >> 24) & 255 as r, (rgba >> 16) & 255 as g, (rgba >> 8) & 255 as b, rgba & 255 as a from ex",
    "classes", "crop_labels", extra=[EXACT]))
def q_rgba_unpack(spark, sf):
    c = co.colormap_exact(fx.classes(spark, sf).select("gx", "gy", "value"), "value", fx.crop_labels(spark))
    ch = co.rgba_unpack("rgba")
    return c.select("gx", "gy", *[ch[k].alias(k) for k in ("r", "g", "b", "a")])


@register("rgb_to_hsv", with_ctes(
    f"select gx, gy, round(_h, 6) as h, round(_s, 6) as s, round(_v, 6) as v from (select gx, gy, {s_hsv_cols('r', 'g', 'b', '_')} from rgba) t",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA))
def q_rgb_to_hsv(spark, sf):
    t = co.rgb_to_hsv(render.landsat_rgba(_composite(spark, sf)), "r", "g", "b", "_")
    return t.select("gx", "gy", r6("_h", "h"), r6("_s", "s"), r6("_v", "v"))


@register("hsv_roundtrip", with_ctes(
    f"""select gx, gy, round(r2, 6) as r, round(g2, 6) as g, round(b2, 6) as b from (
          select gx, gy, {s_rgb_from_hsv('_h', '_s', '_v', ('r2', 'g2', 'b2'))} from hsv0) t""",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA + SHADED[:1]))
def q_hsv_roundtrip(spark, sf):
    t = co.rgb_to_hsv(render.landsat_rgba(_composite(spark, sf)), "r", "g", "b", "_")
    c = co.hsv_to_rgb_cols("_h", "_s", "_v")
    return t.select("gx", "gy", *[F.round(c[k], 6).alias(k) for k in ("r", "g", "b")])


@register("shade_composite", with_ctes(
    f"select gx, gy, {s_uint8('sr')} as r, {s_uint8('sg')} as g, {s_uint8('sb')} as b, a from shaded",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA + SHADED))
def q_shade_composite(spark, sf):
    return render.render_with_hillshade(_composite(spark, sf))


REPL = ("repl as (select *, case when nlcd between 22 and 24 then r else sr end as xr, "
        "case when nlcd between 22 and 24 then g else sg end as xg, "
        "case when nlcd between 22 and 24 then b else sb end as xb from shaded)")


@register("replace_classes", with_ctes(
    f"select gx, gy, {s_uint8('xr')} as r, {s_uint8('xg')} as g, {s_uint8('xb')} as b, a from repl",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA + SHADED + [REPL]))
def q_replace_classes(spark, sf):
    return render.replace_classes(_composite(spark, sf))


@register("tone_gamma", with_ctes(
    f"select gx, gy, " + ", ".join(f"round({s_gamma(s_unit(k), 1.2)}, 6) as {k}" for k in "rgb") + " from rgba",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA))
def q_tone_gamma(spark, sf):
    t = render.landsat_rgba(_composite(spark, sf))
    return t.select("gx", "gy", *[F.round(co.gamma(co.to_unit(k), 1.2), 6).alias(k) for k in "rgb"])


@register("tone_sigmoidal", with_ctes(
    f"select gx, gy, " + ", ".join(f"round({s_sigmoid(s_gamma(s_unit(k), 1.2), 3, 0.45)}, 6) as {k}" for k in "rgb")
    + " from rgba", *COMPOSITE_CTES, extra=COMPOSITE_EXTRA))
def q_tone_sigmoidal(spark, sf):
    t = render.landsat_rgba(_composite(spark, sf))
    return t.select("gx", "gy", *[F.round(co.sigmoidal(co.gamma(co.to_unit(k), 1.2), 3, 0.45), 6).alias(k) for k in "rgb"])


@register("tone_saturation", with_ctes(
    f"""select gx, gy, round(r2, 6) as r, round(g2, 6) as g, round(b2, 6) as b from (
          select gx, gy, {s_sat_cols('ur', 'ug', 'ub', 2.0, ('r2', 'g2', 'b2'))} from (
            select gx, gy, {s_unit('r')} as ur, {s_unit('g')} as ug, {s_unit('b')} as ub from rgba) u) t""",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA))
def q_tone_saturation(spark, sf):
    t = render.landsat_rgba(_composite(spark, sf))
    t = t.select("gx", "gy", *[co.to_unit(k).alias(f"u{k}") for k in "rgb"])
    s = co.saturation("ur", "ug", "ub", 2.0)
    return t.select("gx", "gy", *[F.round(s[k], 6).alias(k) for k in "rgb"])


def _tone_sql(src, out):
    return ", ".join(f"{s_sigmoid(s_gamma(s_unit(s), 1.2), 3, 0.45)} as {o}" for s, o in zip(src, out))


R3 = [f"t1 as (select *, {_tone_sql(('xr', 'xg', 'xb'), ('c1r', 'c1g', 'c1b'))} from repl)",
      f"t2 as (select *, {s_sat_cols('c1r', 'c1g', 'c1b', 2.0, ('wr', 'wg', 'wb'))} from t1)",
      "t3 as (select *, " + ", ".join(f"(case when nlcd = 11 then w{k} else c1{k} end) * 256 as f{k}" for k in "rgb")
      + " from t2)"]
ALPHA_W = "case when nlcd = 11 then cast(floor(a * 0.8) as integer) else a end"


@register("render_composite", with_ctes(
    f"select gx, gy, {s_uint8('fr')} as r, {s_uint8('fg')} as g, {s_uint8('fb')} as b, {s_uint8(ALPHA_W)} as a from t3",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA + SHADED + [REPL] + R3))
def q_render_composite(spark, sf):
    return render.render3(_composite(spark, sf))


R4 = [f"""n0 as (select *, coalesce((nir{D} - red{D}) / nullif(nir{D} + red{D}, 0), 0) as ndvi,
          {_tone_sql(('sr', 'sg', 'sb'), ('c1r', 'c1g', 'c1b'))} from shaded)""",
      f"n1 as (select *, {s_sat_cols('c1r', 'c1g', 'c1b', 2.0, ('wr', 'wg', 'wb'))} from n0)",
      "n2 as (select *, " + ", ".join(f"case when nlcd = 11 then w{k} else c1{k} end as c2{k}" for k in "rgb") + " from n1)",
      f"n3 as (select *, case when ndvi > 0.45{D} then {s_sigmoid(s_gamma('c2g', 1.1), 7, 0.42)} else c2g end as g3 from n2)",
      f"n4 as (select *, {s_sat_cols('c2r', 'g3', 'c2b', 0.7, ('dr', 'dg', 'db'))} from n3)",
      "n5 as (select *, case when ndvi > 0.45::double then dr else c2r end as c4r, "
      "case when ndvi > 0.45::double then dg else g3 end as c4g, case when ndvi > 0.45::double then db else c2b end as c4b from n4)",
      f"n6 as (select *, {s_sat_cols('c4r', 'c4g', 'c4b', 1.2, ('er', 'eg', 'eb'))}, "
      f"{_tone_sql(('r', 'g', 'b'), ('l1r', 'l1g', 'l1b'))} from n5)",
      f"n7 as (select *, {s_sat_cols('l1r', 'l1g', 'l1b', 0.1, ('mr', 'mg', 'mb'))} from n6)",
      "n8 as (select *, " + ", ".join(f"case when nlcd between 22 and 24 then m{k} * 256 else e{k} * 256 end as z{k}"
                                      for k in "rgb") + " from n7)"]


@register("render_composite_ndvi", with_ctes(
    f"select gx, gy, {s_uint8('zr')} as r, {s_uint8('zg')} as g, {s_uint8('zb')} as b, {s_uint8(ALPHA_W)} as a from n8",
    *COMPOSITE_CTES, extra=COMPOSITE_EXTRA + SHADED + R4))
def q_render_composite_ndvi(spark, sf):
    return render.render4(_composite(spark, sf))
