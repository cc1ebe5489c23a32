"""Colour composites of co-located layers (C3, H14-H27) as a batch job.

The reference renders tiles on request inside a tile server; here the same
per-pixel rules run as one Spark job over the joined layers and produce
``r, g, b, a`` byte columns (PNG encoding and serving are out of scope).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.functions import color as co
from gridsmith.functions.cells import to_cell_type
from gridsmith.functions.indices import ndvi_safe


def composite_join(landsat: DataFrame, hillshade: DataFrame, nlcd: DataFrame) -> DataFrame:
    """Co-locate the layers' cells: chained inner equi-joins on the pixel
    key (C3), and on ``zoom`` as well where all three are pyramids.  Each join
    shuffles on the key once, or none when AQE sees a small side."""
    levels = ["zoom" in x.columns for x in (landsat, hillshade, nlcd)]
    if any(levels) and not all(levels):
        raise ValueError("pyramids and single levels cannot be joined")
    key = ["zoom"] * all(levels) + ["gx", "gy"]
    return landsat.join(hillshade, key).join(nlcd, key)


def near_cells(cells: DataFrame, others: DataFrame, margin: int = 1, side: int = 64) -> DataFrame:
    """The cells in or next to blocks of ``side`` x ``side`` cells that hold any of ``others``: all within ``margin`` cells of
    one of them (at most ``side``), and few besides.  Cuts a layer to where another one is before costly work on it (a
    hillshade below a composite).  With a ``zoom`` column on both sides, level by level.  The block keys are a partially
    aggregated distinct; whether they are broadcast is left to AQE."""
    level = ["zoom"] if "zoom" in cells.columns and "zoom" in others.columns else []
    block = lambda c: F.floor(c / F.lit(side))
    ends = lambda c: F.sequence(block(F.col(c) - margin), block(F.col(c) + margin))
    keys = (others.select(*level, ends("gx").alias("_bx"), ends("gy").alias("_by")).distinct()
            .select(*level, F.explode("_bx").alias("_bx"), "_by").select(*level, "_bx", F.explode("_by").alias("_by")).distinct())
    return (cells.withColumns({"_bx": block(F.col("gx")), "_by": block(F.col("gy"))})
            .join(keys, [*level, "_bx", "_by"], "left_semi").select(*cells.columns))


def landsat_rgba(df: DataFrame) -> DataFrame:
    return df.withColumns({"r": co.stretch("red"), "g": co.stretch("green"), "b": co.stretch("blue"),
                           "a": co.alpha("blue", "green", "red")})


def _tone(df: DataFrame, src=("sr", "sg", "sb"), out=("c1r", "c1g", "c1b")) -> DataFrame:
    """Bytes -> unit, gamma 1.2, sigmoidal contrast (3, 0.45)."""
    return df.withColumns({o: co.sigmoidal(co.gamma(co.to_unit(s), 1.2), 3, 0.45) for s, o in zip(src, out)})


def _saturate_where(df: DataFrame, cond, src, p: float, out) -> DataFrame:
    t = co.saturation_df(df, src, p, ("_sr", "_sg", "_sb"))
    t = t.withColumns({o: F.when(cond, F.col(k)).otherwise(F.col(c)) for o, k, c in zip(out, ("_sr", "_sg", "_sb"), src)})
    return t.drop("_sr", "_sg", "_sb")


def _bytes(df: DataFrame, src, water=True) -> DataFrame:
    a = F.col("a")
    if water:
        a = F.when(F.col("nlcd") == co.WATER_CLASS, F.floor(F.col("a") * 0.8).cast("int")).otherwise(F.col("a"))
    return df.select("gx", "gy", *[to_cell_type(F.col(c), "uint8").alias(o) for c, o in zip(src, ("r", "g", "b"))],
                     to_cell_type(a, "uint8").alias("a"))


def render_with_hillshade(df: DataFrame) -> DataFrame:
    """Landsat RGB shaded by hillshade, as bytes."""
    t = co.shade(landsat_rgba(df), "r", "g", "b", "hillshade")
    return _bytes(t, ("sr", "sg", "sb"), water=False)


def replace_classes(df: DataFrame) -> DataFrame:
    """Developed land (classes 22-24) keeps the unshaded colour."""
    t = co.shade(landsat_rgba(df), "r", "g", "b", "hillshade")
    dev = F.col("nlcd").between(*co.DEVELOPED_CLASSES)
    t = t.withColumns({o: F.when(dev, F.col(s)).otherwise(F.col(h))
                       for o, s, h in zip(("xr", "xg", "xb"), ("r", "g", "b"), ("sr", "sg", "sb"))})
    return _bytes(t, ("xr", "xg", "xb"), water=False)


def render3(df: DataFrame) -> DataFrame:
    """Shade, keep developed colours, tone curves, saturate water, water
    at 80 % opacity (H26/H27)."""
    t = co.shade(landsat_rgba(df), "r", "g", "b", "hillshade")
    dev = F.col("nlcd").between(*co.DEVELOPED_CLASSES)
    t = t.withColumns({o: F.when(dev, F.col(s)).otherwise(F.col(h))
                       for o, s, h in zip(("xr", "xg", "xb"), ("r", "g", "b"), ("sr", "sg", "sb"))})
    t = _tone(t, ("xr", "xg", "xb"))
    t = _saturate_where(t, F.col("nlcd") == co.WATER_CLASS, ("c1r", "c1g", "c1b"), 2.0, ("c2r", "c2g", "c2b"))
    t = t.withColumns({f"f{k}": F.col(f"c2{k}") * 256 for k in "rgb"})
    return _bytes(t, ("fr", "fg", "fb"))


def render4(df: DataFrame) -> DataFrame:
    """render3 plus NDVI-driven tone rules (H27 with H4)."""
    t = co.shade(landsat_rgba(df).withColumn("ndvi", ndvi_safe("red", "nir")), "r", "g", "b", "hillshade")
    t = _tone(t)
    t = _saturate_where(t, F.col("nlcd") == co.WATER_CLASS, ("c1r", "c1g", "c1b"), 2.0, ("c2r", "c2g", "c2b"))
    green = F.col("ndvi") > 0.45
    t = t.withColumn("g3", F.when(green, co.sigmoidal(co.gamma("c2g", 1.1), 7, 0.42)).otherwise(F.col("c2g")))
    t = _saturate_where(t, green, ("c2r", "g3", "c2b"), 0.7, ("c4r", "c4g", "c4b"))
    t = co.saturation_df(t, ("c4r", "c4g", "c4b"), 1.2, ("er", "eg", "eb"))
    t = t.withColumns({f"f{k}": F.col(f"e{k}") * 256 for k in "rgb"})
    t = _tone(t, ("r", "g", "b"), ("l1r", "l1g", "l1b"))
    t = co.saturation_df(t, ("l1r", "l1g", "l1b"), 0.1, ("mr", "mg", "mb"))
    t = t.withColumns({f"l{k}": F.col(f"m{k}") * 256 for k in "rgb"})
    dev = F.col("nlcd").between(*co.DEVELOPED_CLASSES)
    t = t.withColumns({f"z{k}": F.when(dev, F.col(f"l{k}")).otherwise(F.col(f"f{k}")) for k in "rgb"})
    return _bytes(t, ("zr", "zg", "zb"))
