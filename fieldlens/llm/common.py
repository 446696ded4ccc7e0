"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte tables: only A-Z change case; every other ASCII byte outside 0-9 a-z
# separates words.  UTF-8 bytes of other characters are never touched, so the
# result equals the same rule applied to characters.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORDS = bytes(
    LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

# Arrow rows per batch while whole texts pass through Python workers.
TEXT_ROWS = 2000
# The same for the pipeline's operators: what a large batch takes off the heap
# and in the workers stays with the executor for all later stages.
STAGE_ROWS = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return (text or b"").translate(WORDS).split()


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, or with underscores added until no column clashes with it
    (column names compare without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base = "_" + base
    return base


def releasing(batches):
    """``batches``; at the end of the task Arrow gives the memory it keeps for
    later batches back, since the worker lives on through other stages."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name (Spark's own fails
    on a dot): columns travel under their positions, ``run`` must not ask for
    names."""
    places = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])

    def placed(batches):
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(b.columns, names=places.names)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(placed, places).toDF(*schema.names)


def shuffle_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished, unreferenced jobs now.

    Its cleaner acts when the driver's JVM collects garbage, which an idle heap
    may put off for half an hour; an operator of several large exchanges, each
    written to a table, would keep them all on the executors' disks until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unit_hash(*cols: Column | str, seed: int) -> Column:
    """Hash of the columns as a number in [0, 1)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(2**53))


def rank_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   out: str, seed: int = 11, buckets: int | None = None) -> DataFrame:
    """Gapless rank (from 0) of each row in its group, in a random order fixed
    by ``seed`` and the ``order`` columns.

    A group of any size is spread over ``buckets`` slices by a hash of the
    order columns: slice counts are aggregated first (map-side), their running
    sums give each slice its first rank, and rows are numbered per
    (group, slice).  No task sees a whole group.  ``df`` is read twice, so pass
    a written table.
    """
    n = buckets or shuffle_buckets(df.sparkSession)
    b = "__slice"
    sliced = df.withColumn(b, F.floor(unit_hash(*order, seed=seed) * n).cast("int"))
    counts = sliced.groupBy(*group, b).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*group, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    local = Window.partitionBy(*group, b).orderBy(F.xxhash64(F.lit(seed + 1), *order), *order)
    numbered = sliced.withColumn("__r", F.row_number().over(local) - 1)
    return (
        numbered.join(first, [*group, b])
        .withColumn(out, F.col("__first") + F.col("__r"))
        .select(*df.columns, out)
    )
