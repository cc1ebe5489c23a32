"""Tile layers stored in buckets, so that a space-time layer meets a static one without a shuffle.

Both layers are bucketed alike on ``(col, row, slot)``: Spark then joins bucket to bucket.  The slot of an imagery tile is
a hash of its date, and a static tile is stored once per slot.  So the dates of one hot tile lie in ``SLOTS`` buckets, for
``SLOTS`` copies of the static layer, which has one date where the imagery has hundreds.  Join layers of equal buckets and slots.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 8
KEYS = ["col", "row", "slot"]


def _write(tiles: DataFrame, path: str, buckets: int) -> str:
    """One sorted file a bucket, registered under a fresh name in the session's catalog."""
    name = "bucketed_" + uuid.uuid4().hex
    keyed = tiles.withColumns({"col": F.col("col").cast("long"), "row": F.col("row").cast("long"), "slot": F.col("slot").cast("int")})
    keyed.repartition(buckets, *KEYS).write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
    return name


def write_series(tiles: DataFrame, path: str, buckets: int, slots: int = SLOTS) -> str:
    """Store tiles ``(instant, col, row, ...)``; the table's name.  A tile without a date is in slot 0."""
    slot = F.when(F.col("instant").isNull(), 0).otherwise(F.pmod(F.xxhash64("instant"), F.lit(slots)))
    return _write(tiles.withColumn("slot", slot), path, buckets)


def write_static(tiles: DataFrame, path: str, buckets: int, slots: int = SLOTS) -> str:
    """Store tiles ``(col, row, ...)``, one copy a slot; the table's name."""
    return _write(tiles.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))), path, buckets)


def join_static(spark: SparkSession, series: str, static: str) -> DataFrame:
    """Each date of a tile with the static tile of its key; neither side is shuffled."""
    return spark.table(series).join(spark.table(static), KEYS).drop("slot")
