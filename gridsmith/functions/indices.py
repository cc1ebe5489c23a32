"""Band math as Column expressions (map algebra, spectral indices, clouds).

All divisions go through ``try_divide`` (Spark 4 runs with ANSI on, where
``x / 0`` raises); 0/0 and x/0 therefore come out as NULL = NoData.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band order of the imagery layer and its NoData code.
BANDS = {"Blue": 0, "Green": 1, "Red": 2, "NIR": 3, "QA": 4}
BAND_COLUMNS = ["blue", "green", "red", "nir", "qa"]
IMAGERY_NODATA = 0
CLOUD_BITS_SHIFT = 14      # QA bits 14-15 ...
CLOUD_CODE = 3             # ... both set = cloud


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nodata_to_null(v, nodata) -> Column:
    """Analysis form: the NoData code (or NaN) becomes NULL."""
    v = _c(v)
    if nodata is None:
        return v
    if isinstance(nodata, float) and nodata != nodata:  # NaN NoData
        return F.when(~F.isnan(v), v)
    return F.when(v != F.lit(nodata), v)


def to_float(v, nodata=IMAGERY_NODATA) -> Column:
    """Cell-type conversion to float64 with NoData -> NULL (B2)."""
    return nodata_to_null(v, nodata).cast("double")


def normalized_difference(a, b) -> Column:
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return F.try_divide(a - b, a + b)


def ndvi(red, nir) -> Column:
    """(NIR - Red) / (NIR + Red); NULL where the denominator is 0 (H2)."""
    return normalized_difference(nir, red)


def ndwi(green, nir) -> Column:
    """(Green - NIR) / (Green + NIR) (H3)."""
    return normalized_difference(green, nir)


def ndvi_safe(red, nir) -> Column:
    """NDVI with +inf/NaN replaced by 0, as the composite renderer wants (H4)."""
    return F.coalesce(ndvi(red, nir), F.lit(0.0))


def is_cloud(qa) -> Column:
    return F.shiftright(_c(qa), CLOUD_BITS_SHIFT) == CLOUD_CODE


def cloud_mask(band, qa, fill=IMAGERY_NODATA) -> Column:
    """Band value, or ``fill`` (NoData) where QA flags a cloud (H5)."""
    return F.when(is_cloud(qa), F.lit(fill)).otherwise(_c(band))


def cloud_masked_bands(df, bands=("blue", "green", "red", "nir"), qa="qa"):
    """Mask clouds in every colour band and drop QA (5 bands -> 4)."""
    keep = [c for c in df.columns if c not in bands and c != qa]
    return df.select(*keep, *[cloud_mask(b, qa).alias(b) for b in bands])


def cloud_masked_index(df, kind: str = "ndvi") -> Column:
    """Mask, then index: a cloudy pixel gives 0/0 -> NULL (H6)."""
    red = cloud_mask("red", "qa")
    nir = cloud_mask("nir", "qa")
    green = cloud_mask("green", "qa")
    return ndvi(red, nir) if kind == "ndvi" else ndwi(green, nir)
