"""Readers for the given Parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridsmith.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table; selecting ``columns`` right at the scan keeps the
    ReadSchema narrow (column pruning reaches Parquet)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
