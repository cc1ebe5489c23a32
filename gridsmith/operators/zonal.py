"""Layer statistics: class histograms, min/max, mean time series, zonal stats.

Everything is a built-in aggregate, so Spark runs a partial (map-side)
aggregate before the shuffle: a hot class or instant holding a third of all
cells still moves only one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsmith.plans.sizing import broadcast_if_small


def drop_nodata(cells: DataFrame, value: str = "value", nodata=0) -> DataFrame:
    """Drop NoData cells."""
    c = F.col(value)
    cond = c.isNotNull() if nodata is None else (c.isNotNull() & (c != F.lit(nodata)))
    return cells.where(cond)


def class_histogram(cells: DataFrame, value: str = "value", nodata=0) -> DataFrame:
    """``(value, cells)``: number of non-NoData cells per class."""
    return (drop_nodata(cells, value, nodata).groupBy(F.col(value).alias("value"))
            .agg(F.count("*").alias("cells")))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sum two ``(value, cells)`` count tables over the union of keys."""
    return a.unionByName(b).groupBy("value").agg(F.sum("cells").alias("cells"))


def distinct_values(cells: DataFrame, value: str = "value") -> DataFrame:
    """Distinct values with their counts, NoData included (D16, np.unique)."""
    return cells.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("cells"))


def class_whitelist(cells: DataFrame, allowed: DataFrame, value: str = "value", code: str = "code") -> DataFrame:
    """Keep cells whose class is in ``allowed`` (B13); the code list is
    broadcast after a size check."""
    return cells.join(broadcast_if_small(allowed.select(F.col(code).alias(value)).distinct()), value, "left_semi")


def label_lookup(counts: DataFrame, labels: DataFrame, value: str = "value") -> DataFrame:
    """Attach ``name`` (and the rest of the lookup) to codes (C6).  Missing
    codes keep a NULL label.  The lookup is broadcast after a size check."""
    lk = labels.withColumnRenamed("code", value)
    return counts.join(broadcast_if_small(lk), value, "left")


def label_to_code(labels: DataFrame, *extra_aggs) -> DataFrame:
    """Inverse lookup ``name -> code``; for a duplicated name the last (largest)
    code wins, as when a dict is inverted in code order (C7).  Extra
    aggregates (e.g. summed counts) ride along in the same ``groupBy``."""
    return (labels.where(F.col("name").isNotNull()).groupBy("name")
            .agg(F.max("code").alias("code"), *extra_aggs))


def top_classes(counts: DataFrame, k: int = 3) -> DataFrame:
    """Top-k classes by cell count, ties by smaller code."""
    return counts.orderBy(F.desc("cells"), F.asc("value")).limit(k)


def min_max(cells: DataFrame, value: str) -> DataFrame:
    """Min and max ignoring NoData/NULL (D3)."""
    return cells.agg(F.min(value).alias("min"), F.max(value).alias("max"))


def mean_series(cells: DataFrame, value: str, by: tuple[str, ...] = ("instant",)) -> DataFrame:
    """Per instant (and optionally per zone), mean of non-NULL values and
    their count (D4).  NaN must already be NULL (``avg`` over NaN is NaN)."""
    return (cells.groupBy(*by)
            .agg(F.avg(value).alias("mean"), F.count(value).alias("n")))


def series_dropna(series: DataFrame, value: str = "mean") -> DataFrame:
    """Drop missing values."""
    v = F.col(value)
    return series.where(v.isNotNull() & ~F.isnan(v))


def series_threshold(series: DataFrame, value: str = "mean", eps: float = 0.001) -> DataFrame:
    """Keep |v| > eps (noise cut)."""
    return series.where(F.abs(F.col(value)) > F.lit(eps))


def series_nullif_zero(series: DataFrame, value: str = "mean", eps: float = 0.001) -> DataFrame:
    """Zeros become missing, then the noise cut drops them."""
    s = series.withColumn(value, F.nullif(F.col(value), F.lit(0.0)))
    return series_threshold(series_dropna(s, value), value, eps)


def argmax_time(series: DataFrame, value: str = "mean", by: tuple[str, ...] = ()) -> DataFrame:
    """Instant of the maximum value; ties go to the earliest instant.
    ``max_by`` over a struct key keeps it one partial aggregate."""
    key = F.struct((-F.col(value)).alias("v"), F.col("instant").alias("t"))
    g = series.where(F.col(value).isNotNull() & ~F.isnan(value))
    return g.groupBy(*by).agg(F.min_by("instant", key).alias("instant"), F.max(value).alias(value))
