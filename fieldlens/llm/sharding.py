"""Uniform shuffle into shards of exact sizes by a communication matrix.

Rows lie in blocks (a random hash of a stored row number, so equal rows spread
too).  How many rows of each block go to each shard is drawn from the exact
multivariate hypergeometric distribution; rows are permuted within their block,
the first ones go to shard 0, the next to shard 1 and so on; after the exchange
each shard is permuted again.  The outcome is a uniformly random permutation
cut into shards whose row counts differ by at most one.

Scale: the driver sees one count per block (one per ``rows_per_block`` rows)
and never a row.  The second permutation numbers a shard by slices, so neither
pass needs a whole shard, source or group of copies in one task.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import named, rank_in_groups, shuffle_buckets, table, unit_hash
from fieldlens.session import Scratch

ROWS_PER_BLOCK = 200_000


def draw_matrix(block_sizes: Sequence[int], n_shards: int, seed: int) -> np.ndarray:
    """Blocks x shards counts: row sums are the block sizes, column sums the
    shard sizes (at most one apart), drawn as a random permutation of all rows
    would give them."""
    rng = np.random.default_rng(seed)
    total = int(sum(block_sizes))
    left = np.full(n_shards, total // n_shards, dtype=np.int64)
    left[: total % n_shards] += 1
    out = np.zeros((len(block_sizes), n_shards), dtype=np.int64)
    for i, n in enumerate(block_sizes):
        out[i] = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        left -= out[i]
    return out


def shuffle_shards(df: DataFrame, scratch: Scratch, n_shards: int = 24, seed: int = 20,
                   rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``df`` with columns ``shard`` (0..n_shards-1) and ``slot`` (gapless from
    0 in each shard, a random order).

    Every row of ``df`` is placed once, whatever its values: nulls, empty
    texts and repeated rows are rows like any other.  An empty frame stays
    empty.  Columns already called shard or slot are replaced, others may have
    any name and type.  Pass a narrow frame (keys and sizes): all its columns,
    very long texts among them, are exchanged.
    """
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    # columns travel under their positions, so no name can clash
    df = df.select(*(named(c).alias(f"c{i}") for i, c in enumerate(names)))
    spark = df.sparkSession
    # The stored row number makes every later hash stable under task retries.
    rows = scratch.table(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    n = rows.count()
    n_blocks = max(shuffle_buckets(spark), -(-n // rows_per_block))
    blocked = rows.withColumn("__block", F.floor(unit_hash("__row", seed=seed) * n_blocks).cast("int"))
    sizes = {r[0]: r[1] for r in blocked.groupBy("__block").count().toLocalIterator()}
    blocks = sorted(sizes)
    ends = np.cumsum(draw_matrix([sizes[b] for b in blocks], n_shards, seed), axis=1)
    matrix = spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps([{"__block": b, "__ends": e.tolist()} for b, e in zip(blocks, ends)])),
        "array<struct<__block:int,__ends:array<bigint>>>")).alias("m")).select("m.*")
    local = Window.partitionBy("__block").orderBy(F.xxhash64(F.lit(seed + 1), "__row"), "__row")
    sent = (
        blocked.withColumn("__r", F.row_number().over(local) - 1)
        .join(matrix, "__block")
        .withColumn("shard", F.size(F.filter("__ends", lambda e: e <= F.col("__r"))))
        .drop("__block", "__ends", "__r")
    )
    exchanged = scratch.table(sent, "sent")
    ranked = rank_in_groups(exchanged, ["shard"], ["__row"], "slot", seed=seed + 2)
    return ranked.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "shard", "slot")


def document_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, null 0, plus 8) and the CRC-32
    of the text's bytes (null as empty: 0)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law ``rows``."""
    with Scratch(spark, "op5") as scratch:
        placed = shuffle_shards(document_digest(table(spark, sf_dir, "documents")), scratch)
        out = scratch.table(placed.select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")), "out")
        scratch.keep("out")
        return out
