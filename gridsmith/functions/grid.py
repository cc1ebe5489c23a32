"""Grid arithmetic: tile keys, extents, windows, space-filling-curve keys.

The layout is the global power-of-two grid: zoom z has 2^z x 2^z tiles of
``n`` cells each side; global pixel (gx, gy) lies in tile (gx div n, gy div n).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridsmith.operators.geometry import WM_HALF_WIDTH


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tile_of(g, n: int) -> Column:
    """Tile index of a global pixel coordinate (non-negative coordinates)."""
    return F.floor(_c(g) / F.lit(n))


def key_to_extent(col, row, zoom: int, half_width: float = WM_HALF_WIDTH) -> dict[str, Column]:
    """Tile key -> web-mercator extent; rows count downwards from the top."""
    size = 2 * half_width / (2 ** zoom)
    c, r = _c(col).cast("double"), _c(row).cast("double")
    return {"xmin": F.lit(-half_width) + c * F.lit(size), "xmax": F.lit(-half_width) + (c + 1) * F.lit(size),
            "ymax": F.lit(half_width) - r * F.lit(size), "ymin": F.lit(half_width) - (r + 1) * F.lit(size)}


def window_extent(xmin, ymax, xres, yres, col_off, row_off, width, height) -> dict[str, Column]:
    """Pixel window -> extent by linear interpolation, y downwards (H9)."""
    x0 = _c(xmin) + _c(col_off) * _c(xres)
    y1 = _c(ymax) - _c(row_off) * _c(yres)
    return {"xmin": x0, "xmax": x0 + _c(width) * _c(xres), "ymax": y1, "ymin": y1 - _c(height) * _c(yres)}


def _spread_bits(v: Column, bits: int, stride: int, offset: int) -> Column:
    """Place bit i of v at position i*stride + offset."""
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        bit = F.shiftright(v.cast("bigint"), i).bitwiseAND(F.lit(1))
        out = out.bitwiseOR(F.shiftleft(bit, i * stride + offset))
    return out


def morton2(x, y, bits: int = 31) -> Column:
    """2-D Z-order (Morton) index: x bits at even, y bits at odd positions."""
    return _spread_bits(_c(x), bits, 2, 0).bitwiseOR(_spread_bits(_c(y), bits, 2, 1))


def morton3(x, y, t, bits: int = 21) -> Column:
    """3-D Z-order index over (x, y, t)."""
    return (_spread_bits(_c(x), bits, 3, 0).bitwiseOR(_spread_bits(_c(y), bits, 3, 1))
            .bitwiseOR(_spread_bits(_c(t), bits, 3, 2)))


def morton_sql(names: list[str], bits: int) -> str:
    """The Z-order index over columns as SQL text: the same value as ``morton2`` and ``morton3``, made in one call."""
    return " | ".join(f"shiftleft(shiftright(cast({n} as bigint), {i}) & 1L, {i * len(names) + k})" for k, n in enumerate(names) for i in range(bits))


# Fixed value: day-resolution time keys count days from this date.
DAY_EPOCH = "2000-01-01"


def days_since_epoch(ts) -> Column:
    return F.datediff(F.to_date(_c(ts)), F.to_date(F.lit(DAY_EPOCH)))


def index_width(max_index: int) -> int:
    """Decimal digits needed for the largest index."""
    return max(1, len(str(max_index)))


def padded_index(idx, width: int) -> Column:
    """Zero-padded decimal text of an index."""
    return F.lpad(_c(idx).cast("string"), width, "0")


def max_morton2(zoom: int) -> int:
    n = 2 ** zoom - 1
    return int(sum(((n >> i) & 1) << (2 * i) | ((n >> i) & 1) << (2 * i + 1) for i in range(max(1, zoom))))


def log2_int(n: int) -> int:
    return int(math.log2(n))


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or ISO text, independent of
    both the session time zone and the Python process time zone."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
