"""Per-pixel compositing across time."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridsmith.functions import indices as ix
from gridsmith.operators import mosaic as mo
from gridsmith.plans.imagery import MASKED
from gridsmith.plans.oracle import with_ctes
from gridsmith.plans.registry import register
from gridsmith.sources import fixtures as fx

BRIGHT = "(blue >= 6000 or green >= 6000 or red >= 6000)"
VALID = "(blue <> 0 or green <> 0 or red <> 0)"


def _ranked(order: str, src: str = "masked") -> str:
    return f"""select gx, gy, blue, green, red, nir from (
      select *, row_number() over (partition by gx, gy order by {order},
        blue desc nulls last, green desc nulls last, red desc nulls last, nir desc nulls last) as rn
      from {src}) t where rn = 1"""


def masked(spark, sf):
    return ix.cloud_masked_bands(fx.landsat(spark, sf))


@register("mosaic_bright", with_ctes(_ranked(f"{BRIGHT} desc, instant desc"), "landsat", extra=[MASKED]))
def q_mosaic_bright(spark, sf):
    return mo.mosaic(masked(spark, sf), "bright")


@register("mosaic_valid", with_ctes(_ranked(f"{VALID} desc, instant desc"), "landsat", extra=[MASKED]))
def q_mosaic_valid(spark, sf):
    return mo.mosaic(masked(spark, sf), "valid")


@register("mosaic_greenest", with_ctes(
    _ranked(f"{BRIGHT} desc, (nir::double - red::double) / nullif(nir::double + red::double, 0) desc nulls last, instant desc"),
    "landsat", extra=[MASKED]))
def q_mosaic_greenest(spark, sf):
    return mo.mosaic(masked(spark, sf), "greenest")


@register("collapse_time", with_ctes(_ranked("instant desc", "landsat"), "landsat"))
def q_collapse_time(spark, sf):
    return mo.collapse_time(fx.landsat(spark, sf))


@register("tile_merge", with_ctes(
    """select gx, gy, nir from (
         select gx, gy, nir, row_number() over (partition by gx, gy order by instant desc, nir desc) as rn
         from (select gx, gy, instant, case when qa >> 14 <> 3 then nir end as nir from landsat) s
         where nir is not null) t where rn = 1""", "landsat"))
def q_tile_merge(spark, sf):
    """Overlapping sources per cell (one per date, clouds = NULL): the
    newest valid value wins (D12)."""
    l = fx.landsat(spark, sf)
    cells = l.select("gx", "gy", "instant", F.when(~ix.is_cloud("qa"), F.col("nir")).alias("nir"))
    return mo.tile_merge(cells, "nir", "instant")


@register("union_batches", with_ctes(_ranked("instant desc", "landsat"), "landsat"))
def q_union_batches(spark, sf):
    """Two ingest batches (even / odd years) appended into one layer and
    merged per pixel: youngest wins (U1)."""
    l = fx.landsat(spark, sf)
    even = l.where(F.year("instant") % 2 == 0)
    odd = l.where(F.year("instant") % 2 == 1)
    return mo.collapse_time(even.unionByName(odd))
