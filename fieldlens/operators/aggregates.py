"""Aggregations: group means in long form (E1), long -> wide pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.session import materialize_observed


def exact_mean(c: Column | str) -> Column:
    """Mean of non-null values as double(sum) / count.

    On a DECIMAL column the sum is exact, so the mean has the same bits on any
    engine and for any row order; null when there is no value.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def group_mean_long(df: DataFrame, keys: Sequence[str], value: str = "value",
                    out: str = "value") -> DataFrame:
    """One row per key combination with the mean of ``value``.  Rows with
    a null key are dropped, as a pandas group-by does."""
    k = list(keys)
    cond = F.lit(True)
    for c in k:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*k).agg(exact_mean(value).alias(out))


def pivot_mean(df: DataFrame, keys: Sequence[str], pivot: str, values: Sequence[str],
               value: str = "value", *, drop_unseen: bool = True) -> DataFrame:
    """E1+E2 in one step: one row per key, one column per pivot value holding
    the mean of ``value``.  Rows with a null key are dropped first.  With
    ``drop_unseen`` a requested pivot value that no remaining row has gives no
    column (as a pandas pivot over the data does), so the schema depends on
    the data; without it every value has its column, null where unseen.

    One aggregate with a conditional sum and count per listed value: one
    shuffle and one pass over the input.  For ``drop_unseen`` the (already
    aggregated) result is written, and the write itself observes which values
    it holds.
    """
    k = list(keys)
    cond = F.lit(True)
    for c in k:
        cond = cond & F.col(c).isNotNull()
    of = [F.col(pivot) == F.lit(v) for v in values]
    wide = df.where(cond).groupBy(*k).agg(
        *[exact_mean(F.when(is_v, F.col(value))).alias(f"_m{i}") for i, is_v in enumerate(of)],
        *[F.count(F.when(is_v, 1)).alias(f"_n{i}") for i, is_v in enumerate(of)])
    shown = list(range(len(values)))
    if drop_unseen and shown:
        wide, n = materialize_observed(wide, [F.max(f"_n{i}").alias(f"_n{i}") for i in shown], "pivot")
        shown = [i for i in shown if n[f"_n{i}"]]
    return wide.select(*k, *[F.col(f"_m{i}").alias(values[i]) for i in shown])
