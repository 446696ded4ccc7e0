"""Catalog-style table scans over a folder of parquet files (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``spark.table`` equivalent for ``<base>/<name>.parquet``.

    The folder is listed at every call, so files added since the last one are
    read.  Projections and filters applied later reach the parquet scan
    (``ReadSchema`` / ``PushedFilters``), so callers never prune by hand.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
