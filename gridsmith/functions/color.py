"""Colour: stretch, colour maps, RGBA packing, HSV, tone curves, shading.

Everything is a Column expression (codegen, no Python in the hot path).
Stages that need several intermediate values are written as ``DataFrame ->
DataFrame`` steps that add columns, so each intermediate is computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsmith.functions.cells import to_cell_type

# Linear stretch window of the imagery bands.
STRETCH_MIN, STRETCH_MAX = 4000, 15176
# NDVI colour ramp, break -> 0xRRGGBBAA (value <= break).
NDVI_BREAKS = [(0.05, 0xffffe5aa), (0.1, 0xf7fcb9ff), (0.2, 0xd9f0a3ff), (0.3, 0xaddd8eff), (0.4, 0x78c679ff),
               (0.5, 0x41ab5dff), (0.6, 0x238443ff), (0.7, 0x006837ff), (1.0, 0x004529ff)]
# NDWI colour ramp, break -> 0xRRGGBBAA (value <= break).
NDWI_BREAKS = [(-0.1, 0xaacdffaa), (0.0, 0x70abffff), (0.05, 0x3086ffff), (0.1, 0x1269e2ff), (0.15, 0x094aa5ff),
               (0.2, 0x012c69ff), (0.25, 0x012cbcff)]
TRANSPARENT = 0x00000000
WATER_CLASS = 11
DEVELOPED_CLASSES = (22, 24)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stretch(v) -> Column:
    """Clamp non-zero values to the stretch window, scale to 0..255.
    Zero (NoData) escapes the clamp, as in the reference; the byte cast
    then truncates toward zero and clips to 0..255 [ours]."""
    v = _c(v)
    clamped = F.when(v != 0, F.least(F.greatest(v, F.lit(STRETCH_MIN)), F.lit(STRETCH_MAX))).otherwise(v)
    return to_cell_type((clamped - STRETCH_MIN) * 255 / F.lit(STRETCH_MAX - STRETCH_MIN), "uint8")


def alpha(blue, green, red, nodata: int = 0) -> Column:
    """0 where all three colour bands are NoData, else 255."""
    none = (_c(blue) == nodata) & (_c(green) == nodata) & (_c(red) == nodata)
    return F.when(none, F.lit(0)).otherwise(F.lit(255))


def colormap_le(v, breaks=NDVI_BREAKS, fallback: int = TRANSPARENT) -> Column:
    """Colour of the smallest break >= v, else ``fallback``."""
    v = _c(v)
    out = None
    for b, rgba in sorted(breaks):
        cond = v <= F.lit(float(b))
        out = F.when(cond, F.lit(rgba)) if out is None else out.when(cond, F.lit(rgba))
    return out.otherwise(F.lit(fallback)).cast("bigint")


def colormap_exact(cells: DataFrame, value: str, colours: DataFrame, fallback: int = TRANSPARENT) -> DataFrame:
    """Exact code -> colour with a transparent fallback (H17); the colour
    table is broadcast after a size check."""
    from gridsmith.plans.sizing import broadcast_if_small
    c = colours.select(F.col("code").alias(value), F.col("rgba").alias("_rgba"))
    out = cells.join(broadcast_if_small(c), value, "left")
    return out.withColumn("rgba", F.coalesce("_rgba", F.lit(fallback).cast("bigint"))).drop("_rgba")


def rgba_unpack(rgba) -> dict[str, Column]:
    """0xRRGGBBAA -> channels."""
    x = _c(rgba).cast("bigint")
    return {"r": F.shiftright(x, 24).bitwiseAND(255), "g": F.shiftright(x, 16).bitwiseAND(255),
            "b": F.shiftright(x, 8).bitwiseAND(255), "a": x.bitwiseAND(255)}


def rgb_to_hsv(df: DataFrame, r: str, g: str, b: str, prefix: str = "") -> DataFrame:
    """RGB (0..255) -> h, s in 0..1 and v in 0..255 (H19).  Hue priority
    red > green > blue when channels tie; grey pixels get h = 0."""
    R, G, B = (F.col(x).cast("double") for x in (r, g, b))
    mx, mn = F.greatest(R, G, B), F.least(R, G, B)
    d = F.when(mn == mx, F.lit(1.0)).otherwise(mx - mn)
    rc, gc, bc = (mx - R) / d, (mx - G) / d, (mx - B) / d
    h = (F.when(mx == R, bc - gc).when(mx == G, F.lit(2.0) + rc - bc).when(mx == B, F.lit(4.0) + gc - rc)
         .otherwise(F.lit(0.0)))
    h6 = h / F.lit(6.0)
    return df.withColumns({f"{prefix}h": h6 - F.floor(h6), f"{prefix}s": (mx - mn) / F.greatest(F.lit(1.0), mx),
                           f"{prefix}v": mx})


def hsv_to_rgb_cols(h, s, v) -> dict[str, Column]:
    """HSV -> RGB by hue sextant."""
    h, s, v = _c(h), _c(s), _c(v)
    i = F.least(F.floor(h * 6), F.lit(5))
    f = h * 6 - i
    p, q, t = v * (F.lit(1.0) - s), v * (F.lit(1.0) - s * f), v * (F.lit(1.0) - s * (F.lit(1.0) - f))

    def pick(*xs):
        e = F.when(i == 0, xs[0])
        for k, x in enumerate(xs[1:], start=1):
            e = e.when(i == k, x)
        return e

    return {"r": pick(v, q, p, p, t, v), "g": pick(t, v, v, q, p, p), "b": pick(p, p, t, v, v, q)}


def hsv_to_rgb_df(df: DataFrame, h: str, s: str, v: str, out=("r", "g", "b"), drop=()) -> DataFrame:
    """Staged HSV -> RGB: sextant, fraction and p/q/t become columns first,
    so wide colour chains stay small expression trees (Catalyst keeps a
    projection separate when its non-trivial outputs are used many times).
    ``drop`` names extra helper columns to remove in the final projection."""
    i6 = F.least(F.floor(F.col(h) * 6), F.lit(5))
    t = df.withColumns({"_i": i6, "_f": F.col(h) * 6 - i6})
    one = F.lit(1.0)
    t = t.withColumns({"_p": F.col(v) * (one - F.col(s)), "_q": F.col(v) * (one - F.col(s) * F.col("_f")),
                       "_t": F.col(v) * (one - F.col(s) * (one - F.col("_f")))})
    i = F.col("_i")

    def pick(*xs):
        e = F.when(i == 0, F.col(xs[0]))
        for k, x in enumerate(xs[1:], start=1):
            e = e.when(i == k, F.col(x))
        return e

    gone = {"_i", "_f", "_p", "_q", "_t", *out, *drop}
    keep = [c for c in df.columns if c not in gone]
    return t.select(*keep, pick(v, "_q", "_p", "_p", "_t", v).alias(out[0]),
                    pick("_t", v, v, "_q", "_p", "_p").alias(out[1]), pick("_p", "_p", "_t", v, v, "_q").alias(out[2]))


def saturation_df(df: DataFrame, src, p: float, out) -> DataFrame:
    """Staged form of :func:`saturation` (same arithmetic)."""
    R, G, B = (F.col(c) for c in src)
    gx, gn = F.greatest(R, G, B), F.least(R, G, B)
    t = df.withColumns({"_mx": gx, "_mn": gn, "_d": F.when(gn == gx, F.lit(1.0)).otherwise(gx - gn)})
    mx, mn, d = F.col("_mx"), F.col("_mn"), F.col("_d")
    rc, gc, bc = (mx - R) / d, (mx - G) / d, (mx - B) / d
    h0 = (F.when(mx == R, bc - gc).when(mx == G, F.lit(2.0) + rc - bc).otherwise(F.lit(4.0) + gc - rc)) / 6
    s = F.when(mx > 0, (mx - mn) / F.when(mx > 0, mx).otherwise(F.lit(1.0))).otherwise(F.lit(0.0))
    t = t.withColumns({"_hh": h0 - F.floor(h0), "_s2": F.least(s * F.lit(p), F.lit(1.0))})
    return hsv_to_rgb_df(t, "_hh", "_s2", "_mx", out, drop=("_mx", "_mn", "_d", "_hh", "_s2"))


def shade(df: DataFrame, r: str, g: str, b: str, z: str, out=("sr", "sg", "sb")) -> DataFrame:
    """Blend hillshade into value: v' = (z*256/200*4 + v)/5."""
    t = rgb_to_hsv(df, r, g, b, "_")
    zz = F.col(z).cast("double") * 256 / 200
    t = t.withColumn("_v", (zz * 4 + F.col("_v")) / 5)
    return hsv_to_rgb_df(t, "_h", "_s", "_v", out, drop=("_h", "_s", "_v"))


def to_unit(x) -> Column:
    """Byte range -> 0..1 (negatives become 0, then / 256)."""
    return F.greatest(_c(x).cast("double"), F.lit(0.0)) / 256


def gamma(x, g: float) -> Column:
    """Gamma curve x^(1/g) on unit values (H23) [ours]."""
    return F.pow(_c(x), F.lit(1.0 / g))


def sigmoidal(x, contrast: float, bias: float) -> Column:
    """Normalised logistic contrast curve on unit values (H24) [ours]."""
    lo = 1.0 / (1.0 + math.exp(contrast * bias))
    hi = 1.0 / (1.0 + math.exp(contrast * (bias - 1.0)))
    y = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(contrast) * (F.lit(bias) - _c(x))))
    return (y - F.lit(lo)) / F.lit(hi - lo)


def saturation(r, g, b, p: float) -> dict[str, Column]:
    """Scale HSV saturation by ``p`` (capped at 1) on unit RGB (H25) [ours]."""
    R, G, B = _c(r), _c(g), _c(b)
    mx, mn = F.greatest(R, G, B), F.least(R, G, B)
    d = F.when(mn == mx, F.lit(1.0)).otherwise(mx - mn)
    rc, gc, bc = (mx - R) / d, (mx - G) / d, (mx - B) / d
    h = (F.when(mx == R, bc - gc).when(mx == G, F.lit(2.0) + rc - bc).otherwise(F.lit(4.0) + gc - rc)) / 6
    h = h - F.floor(h)
    s = F.when(mx > 0, (mx - mn) / F.when(mx > 0, mx).otherwise(F.lit(1.0))).otherwise(F.lit(0.0))
    s2 = F.least(s * F.lit(p), F.lit(1.0))
    return hsv_to_rgb_cols(h, s2, mx)
