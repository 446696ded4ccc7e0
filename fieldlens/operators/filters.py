"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_filter(df: DataFrame, pairs: Sequence[tuple], cols: Sequence[str]) -> DataFrame:
    """Keep rows whose ``cols`` equal one of the literal tuples.

    Written as an OR of ANDs; Catalyst turns each conjunct into parquet
    pushed filters and the OR into an ``In``-style scan predicate.
    """
    if not pairs:
        return df.where(F.lit(False))
    conds = [
        reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(cols, p)])
        for p in pairs
    ]
    return df.where(reduce(lambda a, b: a | b, conds))


def semi_filter(df: DataFrame, targets: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C1 for a target list that is itself a table: a left-semi join.

    The planner broadcasts ``targets`` only when its runtime size is under the
    broadcast threshold; otherwise both sides shuffle on ``cols``.
    """
    return df.join(targets.select(*cols).distinct(), on=list(cols), how="left_semi")


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows null in any column of ``subset``."""
    return df.dropna(how="any", subset=list(subset))


def year_split(df: DataFrame, *, train_max_year: int, holdout_year: int,
               year: str = "Year", required: Sequence[str] = ("5_Year_Avg_Yield",)):
    """Training rows (year <= train_max_year) and hold-out rows
    (year == holdout_year), each without nulls in ``required``."""
    train = drop_null_rows(df.where(F.col(year) <= train_max_year), required)
    hold = drop_null_rows(df.where(F.col(year) == holdout_year), required)
    return train, hold
