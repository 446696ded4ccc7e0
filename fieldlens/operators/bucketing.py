"""Bucketed tables: rows stored by the hash of their keys.

Two tables bucketed alike meet in a join, and a table bucketed by its grouping
or window keys is aggregated, without an exchange: the exchange was paid once,
when the table was written.  The number of buckets is the session's number of
shuffle partitions, so a side that is not bucketed is dealt to the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.session import owned_table, shared_path


def bucketed(df: DataFrame, cols: Sequence[str], name: str, *, sort: Sequence[str] = (),
             buckets: int | None = None) -> DataFrame:
    """``df`` written as a table bucketed by ``cols`` (a file a bucket, sorted
    by ``cols`` and ``sort``) and read back.

    The rows of one key lie in one file; add a slice column
    (:func:`slice_of`) to ``cols`` where a key may hold a large share of them.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = owned_table(spark, name)
    (df.repartition(n, *cols).write.bucketBy(n, *cols).sortBy(*cols, *sort)
     .option("path", shared_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def slice_of(cols: Sequence[str], slices: int) -> Column:
    """Slice number (0..slices-1) of a row from a hash of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(slices)).cast("int")
