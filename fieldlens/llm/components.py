"""Connected components of a link table by large-star / small-star rounds.

Every round is two aggregates and joins over the links; a node's neighbours
are never gathered in one place (only their minimum is), so a star of any
size is one map-side combined aggregate.  Rounds are written to the shared
folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import Scratch


def connected_components(links: DataFrame, scratch: Scratch, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its
    smallest node.  Self links and nulls are ignored; no link gives no row."""
    edges = scratch.table(
        links.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .filter("u <> v").distinct(), "cc0")
    k, state = 0, None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours move to the smallest node around u
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        k += 1
        big = scratch.table(large, f"cc{k}")
        # small star: smaller neighbours and u itself move to the smallest one
        mins = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            big.join(mins, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(mins.select("u", F.col("m").alias("v"))).distinct()
        )
        k += 1
        edges = scratch.table(small, f"cc{k}")
        scratch.drop(f"cc{k - 1}")
        scratch.drop(f"cc{k - 2}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
