"""Contiguous range blocks for splitting hot keys.

A sort-ordered operator (trailing window, rank, quantile) normally sends all
rows of one key to one task.  ``range_blocks`` cuts the rows into contiguous
blocks of the full sort order instead: Spark range-partitions the table by the
sort columns, and the partition number is stored with every row in a written
table.  There is one plan for every size, the number of blocks follows the
shuffle partitions, and every branch that reads the table (and every retried
task) sees the same blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import materialize

BLOCK = "_fl_blk"


def range_blocks(df: DataFrame, cols: Sequence[str], blocks: int | None = None,
                 name: str = "blocks") -> DataFrame:
    """``df`` written once with its block number (0..blocks-1) under the
    ascending order of ``cols`` in column ``_fl_blk``.

    Rows equal in all ``cols`` share a block, so end ``cols`` with a unique
    column where a key can repeat.  ``blocks`` defaults to the session's
    shuffle partitions.
    """
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(
        df.repartitionByRange(n, *cols).withColumn(BLOCK, F.spark_partition_id()), name)
