"""Exact quantiles with linear interpolation, distributed.

``percentile`` (exact) keeps every distinct value of a group in one buffer,
and for a global quantile that buffer lives in one task.  Here the values are
first counted (a map-side combined aggregate, so a value that fills most of
the table is one row per task), the (value, count) rows are cut into range
blocks, the blocks' totals (one row per block) tell which block holds a wanted
rank, and only those blocks are accumulated.  The result equals numpy's default
``percentile`` and SQL ``quantile_cont``: with ``h = (n - 1) * p``,
``v[floor h] + (h - floor h) * (v[ceil h] - v[floor h])`` over the sorted
non-null values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.operators.partitioning import BLOCK, range_blocks


def exact_quantiles_of(df: DataFrame, wanted: Mapping[str, Sequence[float]], *,
                       blocks: int | None = None, drop_nan: bool = True) -> dict[str, list[float | None]]:
    """Exact quantiles of the non-null values of several columns (as double)
    from one pass over ``df``.

    NaN values are left out by default; with ``drop_nan=False`` a column that
    holds one has NaN for every quantile, as numpy gives.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in wanted])
    counts = (
        df.select(F.inline(pairs)).where(F.col("_v").isNotNull())
        .groupBy("_c", "_v").agg(F.count("*").alias("_n"))
    )
    cut = range_blocks(counts, ["_c", "_v"], blocks, "quantiles")
    totals: dict[str, list[tuple[int, int, int]]] = {c: [] for c in wanted}
    for r in sorted(cut.groupBy("_c", BLOCK).agg(
            F.sum(F.when(~F.isnan("_v"), F.col("_n")).otherwise(0)).alias("n"),
            F.sum(F.when(F.isnan("_v"), F.col("_n")).otherwise(0)).alias("nan")).collect()):
        totals[r["_c"]].append((r[BLOCK], r["n"], r["nan"]))

    def place(c: str, rank: int) -> tuple[str, int, int]:
        for b, n, _ in totals[c]:
            if rank < n:
                return c, b, rank
            rank -= n
        raise AssertionError(rank)

    plan: dict[str, list] = {}
    for c, probs in wanted.items():
        n = sum(x for _, x, _ in totals[c])
        if n == 0 or (not drop_nan and any(x for *_, x in totals[c])):
            plan[c] = [None if n == 0 else float("nan")] * len(probs)
            continue
        hs = [(n - 1) * float(p) for p in probs]
        plan[c] = [(place(c, math.floor(h)), place(c, math.ceil(h)), h - math.floor(h)) for h in hs]
    at = {x for steps in plan.values() for s in steps if isinstance(s, tuple) for x in s[:2]}
    val: dict[tuple[str, int, int], float] = {}
    if at:
        w = Window.partitionBy("_c", BLOCK).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        one = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(b).alias("b"), F.lit(r).cast("bigint").alias("r"))
                        for c, b, r in sorted(at)])
        hit = F.filter(one, lambda x: (x["c"] == F.col("_c")) & (x["b"] == F.col(BLOCK))
                       & (x["r"] < F.col("_cum")) & (x["r"] >= F.col("_cum") - F.col("_n")))
        rows = (
            cut.where(F.struct("_c", BLOCK).isin([F.struct(F.lit(c), F.lit(b)) for c, b in {x[:2] for x in at}])
                      & ~F.isnan("_v"))
            .withColumn("_cum", F.sum("_n").over(w))
            .select("_v", F.explode(hit).alias("x")).select("x.*", "_v").collect()
        )
        val = {(r["c"], r["b"], r["r"]): r["_v"] for r in rows}
    out: dict[str, list[float | None]] = {}
    for c, steps in plan.items():
        out[c] = [s if not isinstance(s, tuple) else
                  val[s[0]] if s[0] == s[1] else val[s[0]] + s[2] * (val[s[1]] - val[s[0]]) for s in steps]
    return out


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], *,
                    blocks: int | None = None, drop_nan: bool = True) -> list[float | None]:
    """Exact quantiles of one column (see :func:`exact_quantiles_of`)."""
    return exact_quantiles_of(df, {column: probs}, blocks=blocks, drop_nan=drop_nan)[column]


def quantile_row(df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str],
                 *, blocks: int | None = None) -> DataFrame:
    """The quantiles as a one-row DataFrame with the given column names."""
    vals = exact_quantiles(df, column, probs, blocks=blocks)
    schema = T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])
    return df.sparkSession.createDataFrame([tuple(vals)], schema)


# Sketch size: the rank error of an estimate is about 0.7 % of the rows.
SKETCH_K = 400
RANK_ERROR = 0.02


def write_sketches(df: DataFrame, column: str, path: str, by: str = "Year", k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of the non-null, non-NaN values of ``column`` per ``by``, as a
    table partitioned by it (``by``, n, sketch).

    Only the partitions that ``df`` holds are overwritten, so a refresh passes
    the rows of the touched years and the others' sketches stay.  Sketches are
    partial aggregates of a few KB: no value is exchanged.
    """
    v = F.col(column).cast("double")
    s = df.select(F.col(by), v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy(by).agg(
        F.count("*").alias("n"), F.expr(f"kll_sketch_agg_double(_v, {int(k)})").alias("sketch"))
    (s.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    return df.sparkSession.read.parquet(path)


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(p, n, value): quantiles of all rows behind the sketches, merged.  The
    estimate's rank is within ``RANK_ERROR`` of p; :func:`exact_quantiles` stays
    the default.  No sketch gives no row."""
    one = sketches.agg(F.sum("n").alias("n"), F.expr("kll_merge_agg_double(sketch)").alias("s")).where("n > 0")
    return one.select("n", F.inline(F.array(*[F.struct(
        F.lit(float(p)).alias("p"), F.expr(f"kll_sketch_get_quantile_double(s, {float(p)}D)").alias("value"))
        for p in probs]))).select("p", "n", "value")
