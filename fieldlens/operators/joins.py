"""Equi joins (D1, D2) with the size handling left to AQE or a proven bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.exprs import state_key
from fieldlens.operators.windows import first_per_key


def yield_weather_days(yields: DataFrame, weather: DataFrame, *, county: str = "County",
                       state: str = "State", year: str = "Year", w_county: str = "county_name",
                       w_state: str = "state_abbrev", w_date: str = "date") -> DataFrame:
    """Inner join of yields to the weather of their (state, county) and year
    (keys named differently on both sides), reported per yield row as the
    number of weather days joined and their first and last date.

    The weather side is aggregated per (state, county, year) *before* the join, so
    the plan never materialises yield x day pairs; rows whose county-year has
    no weather are dropped, exactly as by the inner join.
    """
    wy = weather.groupBy(
        state_key(w_state).alias("_ws"), F.col(w_county).alias("_wk"), F.year(w_date).alias("_wy")
    ).agg(
        F.count(F.lit(1)).alias("weather_days"),
        F.min(w_date).alias("first_day"),
        F.max(w_date).alias("last_day"),
    )
    y = yields.withColumn("_sk", state_key(state))
    j = y.join(wy, (y["_sk"] == wy["_ws"]) & (y[county] == wy["_wk"]) & (y[year] == wy["_wy"]), "inner")
    return j.drop("_sk", "_ws", "_wk", "_wy")


def left_join_dim(facts: DataFrame, dim: DataFrame, *, left_on: str, right_on: str,
                  dim_cols: Sequence[str]) -> DataFrame:
    """Left join of a fact table to a dimension keyed by ``right_on``.

    The dimension is reduced to one row per key first (the smallest by
    ``dim_cols``, nulls last), so the join never multiplies fact rows; AQE broadcasts it when its runtime size
    is under the broadcast threshold and shuffles both sides otherwise.
    """
    d = first_per_key(dim.select(F.col(right_on).alias("_dk"), *dim_cols), ["_dk"],
                      [(c, "asc", True) for c in dim_cols])
    j = facts.join(d, facts[left_on] == d["_dk"], "left")
    return j.drop("_dk")
