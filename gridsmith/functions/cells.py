"""Cell-type handling: Spark has no unsigned types, so uint8/uint16 are INT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Value range of each supported cell type.
CELL_TYPE_RANGE = {"uint8": (0, 255), "int8": (-128, 127), "uint16": (0, 65535), "int16": (-32768, 32767)}


def force_cell_type(v: Column, cell_type: str) -> Column:
    """Clip to the cell type's range and store as INT."""
    lo, hi = CELL_TYPE_RANGE[cell_type]
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi)).cast("int")


def to_cell_type(v: Column, cell_type: str) -> Column:
    """float -> integer cell type: truncate toward zero, then clip."""
    lo, hi = CELL_TYPE_RANGE[cell_type]
    return F.least(F.greatest(F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)), F.lit(lo)), F.lit(hi)).cast("int")
