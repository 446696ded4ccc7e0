"""M2: bronze yields + county weather -> gold feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.exprs import STATE_ABBREV, clean_temperature, state_key, yield_status
from fieldlens.operators.bucketing import bucketed
from fieldlens.operators.filters import pair_filter
from fieldlens.operators.lookback import (
    PROBE, daily_weather, lookback_from_seasons, season_features, season_rows,
)
from fieldlens.operators.partitioning import BLOCK
from fieldlens.operators.windows import trailing_mean

AVG_COL = "5_Year_Avg_Yield"
STATUS_COL = "Yield_Status"
# The eight columns the gold table is grouped by.
GOLD_KEYS = ["County", "State", "Year", "Crop", "Harvest_Date", "Yield_Per_Acre",
             AVG_COL, STATUS_COL]


def add_trailing_yield(yields: DataFrame, *, tiebreak: Sequence[str] = ("Harvest_Date",),
                       preceding: int = 5, keep_block: bool = False) -> DataFrame:
    """F1 + C4: mean yield of the previous ``preceding`` rows of the same
    (State, County, Crop) in year order, and the Good / Average / Poor label."""
    y = trailing_mean(yields, ["State", "County", "Crop"], ["Year", *tiebreak], "Yield_Per_Acre",
                      preceding, AVG_COL, keep_block=keep_block)
    return y.withColumn(STATUS_COL, yield_status("Yield_Per_Acre", AVG_COL))


def clean_weather(weather: DataFrame, temp_type: str | None = None) -> DataFrame:
    t = clean_temperature("TAVG", "TMAX", "TMIN")
    if temp_type:
        t = t.cast(temp_type)
    return weather.withColumn("TAVG_Cleaned", t)


def gold_seasons(labelled: DataFrame) -> DataFrame:
    """The labelled yields with their copies counted (``_m``) and the look-back's
    keys.  Copies are counted inside the window's own blocks where these are
    kept, so a group of copies shrinks before it moves."""
    at = [BLOCK] if BLOCK in labelled.columns else []
    g = labelled.groupBy(*GOLD_KEYS, *at).agg(F.count(F.lit(1)).alias("_m"))
    return season_rows(g.select(*GOLD_KEYS, "_m"), GOLD_KEYS)


def gold_from_seasons(rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Gold rows from written season tables: copies that were counted in several
    blocks meet in the bucket they share."""
    whole = rows.groupBy(*GOLD_KEYS, *PROBE).agg(F.sum("_m").alias("_m"))
    f = lookback_from_seasons(whole, season_features(rows, daily, days=(60, 90)))
    m = F.col("_m")

    def mean(n):
        c = F.col(f"tcnt{n}") * m
        return F.when(c > 0, (F.col(f"tsum{n}") * m).cast("double") / c.cast("double"))

    return f.select(
        *GOLD_KEYS,
        (F.col("p60") * m).cast("double").alias("60d_Total_Precip"),
        mean(60).alias("60d_Avg_Temp"),
        (F.col("p90") * m).cast("double").alias("90d_Total_Precip"),
        mean(90).alias("90d_Avg_Temp"),
        (F.col("hot90") * m).cast("bigint").alias("90d_Days_Above_95F"),
    )


def gold_from_labelled(labelled: DataFrame, weather: DataFrame, *, hot_threshold: float = 95.0,
                       temp_type: str | None = None) -> DataFrame:
    """Gold rows from yields that already carry the trailing average and the
    label (see :func:`gold_features`)."""
    rows = bucketed(gold_seasons(labelled), PROBE, "gold-yields")
    return gold_from_seasons(rows, daily_weather(clean_weather(weather, temp_type), hot_threshold=hot_threshold))


def gold_features(
    yields: DataFrame,
    weather: DataFrame,
    *,
    tiebreak: Sequence[str] = ("Harvest_Date",),
    hot_threshold: float = 95.0,
    temp_type: str | None = None,
    pairs: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Gold rows: one per distinct 8-key group, with 60/90-day features.

    Identical yield rows collapse into one group and, as in a join followed by
    a group-by, their rain sums and hot-day counts scale with the number of
    copies (the mean temperature does not).  The copies are counted with a
    partial aggregate before any join, so a group of copies never reaches one
    task as raw rows.

    The yields with window, label and copies are worked out once and stored as a
    bucketed table, which the look-back reads in place.

    ``pairs`` are target (County, State) tuples, states as in the yields; both
    tables are reduced to them before the window and the join, the weather by
    the states' abbreviations.
    """
    if pairs is not None:
        yields = pair_filter(yields, pairs, ["County", "State"])
        weather = pair_filter(weather, [(c, STATE_ABBREV.get(s, s)) for c, s in pairs],
                              ["county_name", "state_abbrev"])
    return gold_from_labelled(add_trailing_yield(yields, tiebreak=tiebreak, keep_block=True), weather,
                              hot_threshold=hot_threshold, temp_type=temp_type)


def season_table(weather: DataFrame) -> DataFrame:
    """(State, County, Year, first_day, last_day, days, rain) per season with
    weather, the states as abbreviations."""
    return weather.where(F.col("date").isNotNull()).groupBy(
        state_key("state_abbrev").alias("State"), F.col("county_name").alias("County"), F.year("date").alias("Year"),
    ).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"),
          F.count_distinct("date").alias("days"), F.sum("PRCP").alias("rain"))


def of_seasons(rows: DataFrame, seasons: DataFrame, *extra: str) -> DataFrame:
    """``rows`` (a written table with State, County, Year) of the picked
    ``seasons``, a filtered table with one row per season, with its columns
    ``extra``.

    The years that occur are known only when the query runs.  Where ``rows`` is
    partitioned by Year and the seasons are small enough to be broadcast, they
    prune its partitions before they are read (dynamic partition pruning);
    where both sides shuffle, a Bloom filter of the seasons' keys drops rows
    before the exchange once the scan is large (Spark's run-time filter, for
    scans above ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``).
    Either is Spark's choice from sizes.  Years and counties are compared as
    they are and states by their abbreviation; null keys never match.
    """
    s = seasons.select(F.col("State").alias("_state"), F.col("County").alias("_county"),
                       F.col("Year").alias("_year"), *extra)
    on = (rows["Year"] == s["_year"]) & (rows["County"] == s["_county"]) & (state_key(rows["State"]) == s["_state"])
    return rows.join(s, on).select(*(rows[c] for c in rows.columns), *extra)
