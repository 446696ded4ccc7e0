"""Window operators: trailing-row averages, best / first row per key.

``trailing_rows_sum_count`` is the skew-safe form of
``avg(v).over(partitionBy(keys).orderBy(order).rowsBetween(-n, -1))``.
A plain window sends every row of one key to one task; if one key holds a
third of the table, one task does a third of the work.  Here every row gets a
contiguous block of the full sort order ``keys + order`` (a range-partitioned
written table, see :mod:`fieldlens.operators.partitioning`), and the window
runs per (key, block), no group larger than a block.  Only the first
``n`` rows of a block need rows of the block before it; those come from a
small table of block tails (<= n rows per block).  Blocks are contiguous
ranges of the global order, so only the smallest key of a block can continue
from an earlier block: the context table has at most one row per block, a
proven bound, safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators.partitioning import BLOCK, range_blocks

_BLK, _POS = BLOCK, "_fl_pos"


def trailing_rows_sum_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    preceding: int,
    *,
    sum_col: str = "_fl_tsum",
    count_col: str = "_fl_tcnt",
    blocks: int | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Add the sum and count of non-null ``value`` over the ``preceding`` rows
    before each row (frame ``rows -preceding .. -1``) within ``keys``.

    ``order`` must be a total order inside a key (end it with a unique id);
    all order columns are ascending.  The sum keeps the value's type, so a
    DECIMAL value gives an exact sum.  The sum is null when the count is 0.
    With ``keep_block`` the block number stays (column ``_fl_blk``): the rows
    are partitioned by keys and block, so an aggregate over both needs no exchange.
    """
    n = int(preceding)
    if n < 1:
        raise ValueError("preceding must be >= 1")
    keys, order = list(keys), list(order)
    v = F.col(value)

    ranged = range_blocks(df, [*keys, *order], blocks, "trailing")
    wb = Window.partitionBy(*keys, _BLK).orderBy(*order)
    before = wb.rowsBetween(-n, -1)
    inner = ranged.select("*", F.row_number().over(wb).alias(_POS), F.sum(v).over(before).alias("_fl_s_in"),
                          F.count(v).over(before).alias("_fl_c_in"))

    # Block tails: the last n rows of every (key, block); a block is one file of
    # the written table, so the group limit leaves <= n rows before the shuffle.
    back = Window.partitionBy(*keys, _BLK).orderBy(*[F.col(x).desc_nulls_last() for x in order])
    tails = ranged.withColumn("_fl_back", F.row_number().over(back)).where(F.col("_fl_back") <= n)

    # Context of a block = the n tail rows of its key before the block's own first
    # one: <= one context row per block, so the broadcast is size-bounded.
    wt = Window.partitionBy(*keys).orderBy(_BLK, *order)
    ctx = tails.select(
        *[F.col(k).alias(f"_fl_k_{k}") for k in keys], F.col(_BLK).alias("_fl_k_blk"),
        F.lag(_BLK).over(wt).alias("_fl_prev"),
        F.collect_list(F.struct(v.alias("v"))).over(wt.rowsBetween(-n, -1)).alias("_fl_ctx"),
    ).where(F.col("_fl_prev") != F.col("_fl_k_blk")).drop("_fl_prev")

    # null-safe keys: a null key is a valid window partition, and no
    # isnotnull filter is inferred into one branch only (so both branches
    # read the same shuffle)
    cond = F.col(_BLK) == F.col("_fl_k_blk")
    for k in keys:
        cond = cond & inner[k].eqNullSafe(F.col(f"_fl_k_{k}"))
    j = inner.join(F.broadcast(ctx), cond, how="left").drop(*[f"_fl_k_{k}" for k in keys], "_fl_k_blk")
    # the first rows of a block take their missing rows from the context's end
    kind = inner.schema["_fl_s_in"].dataType.simpleString()
    missing = f"least({n} + 1 - {_POS}, size(_fl_ctx))"
    rest = f"slice(_fl_ctx, size(_fl_ctx) + 1 - {missing}, {missing})"
    early = f"_fl_ctx IS NOT NULL AND {_POS} <= {n}"
    more_s = (f"CASE WHEN {early} THEN aggregate({rest}, CAST(0 AS {kind}), "
              f"(a, x) -> CAST(a + coalesce(x.v, 0) AS {kind})) ELSE 0 END")
    more_c = f"CASE WHEN {early} THEN size(filter({rest}, x -> x.v IS NOT NULL)) ELSE 0 END"
    j = j.withColumn(count_col, F.expr(f"CAST(_fl_c_in + {more_c} AS bigint)"))
    out = j.withColumn(sum_col, F.expr(
        f"CASE WHEN `{count_col}` > 0 THEN CAST(coalesce(_fl_s_in, 0) + {more_s} AS {kind}) END"))
    return out.drop(*([] if keep_block else [_BLK]), _POS, "_fl_s_in", "_fl_c_in", "_fl_ctx")


def trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    preceding: int,
    out: str,
    *,
    blocks: int | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """mean of ``value`` over the ``preceding`` rows before each row,
    current row excluded; null for the first row of a key.

    Computed as double(sum) / count so a DECIMAL input gives the same bits on
    every engine.
    """
    t = trailing_rows_sum_count(
        df, keys, order, value, preceding, sum_col="_fl_ts", count_col="_fl_tc", blocks=blocks,
        keep_block=keep_block,
    )
    return t.withColumn(
        out, F.col("_fl_ts").cast("double") / F.col("_fl_tc").cast("double")
    ).drop("_fl_ts", "_fl_tc")


def order_columns(specs: Sequence[tuple]) -> list[Column]:
    """Sort columns for ``(column, "asc"|"desc", nulls_last)`` specs of any
    orderable type (strings and timestamps without zone included)."""
    out: list[Column] = []
    for spec in specs:
        name, direction, nulls_last = (tuple(spec) + ("asc", False))[:3]
        c = F.col(name)
        if direction == "desc":
            out.append(c.desc_nulls_last() if nulls_last else c.desc_nulls_first())
        else:
            out.append(c.asc_nulls_last() if nulls_last else c.asc_nulls_first())
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple]) -> DataFrame:
    """keep the first row of each key under a stated total order
    (``dropDuplicates`` would keep an arbitrary row).

    ``row_number() = 1``: Spark keeps only the first row of each key per task
    before the shuffle (WindowGroupLimit), so a key holding a third of all rows
    never reaches one task whole.  ``order`` holds ``(column, "asc"|"desc",
    nulls_last)`` specs of any orderable type; end it with a unique column so
    ties cannot occur.
    """
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    ranked = df.withColumn("_fl_rn", F.row_number().over(w)).where("_fl_rn = 1")
    return ranked.drop("_fl_rn").select(*keys, *[c for c in df.columns if c not in keys])
