"""Set operations (H1, H2) and ordered limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def stack(frames: Sequence[DataFrame], *, allow_missing: bool = False) -> DataFrame:
    """H1/H2: stack frames by column name; with ``allow_missing`` a column
    absent from a frame becomes null (pandas ``concat`` semantics)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows under ``order`` (planned as TakeOrderedAndProject:
    a per-task top-k, then a merge of k rows per task)."""
    return df.orderBy(*order).limit(k)
