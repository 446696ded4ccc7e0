"""Pre-harvest look-back features.

For each yield row, aggregate the daily weather of its (state, county) and year that
falls 0..N days before the harvest date (both ends inclusive), for several N.

Two plans with the same result:

* :func:`lookback_naive` - the textbook form: join every yield row to every
  weather day of its county-year, then conditional aggregates per yield row.
  The join multiplies each yield row by up to 366 weather rows.
* :func:`lookback_features` - the scalable form.  Distinct harvest dates
  (a partial aggregate, so hot keys collapse map-side) are unioned as marker
  rows into the weather, which is first added up per (state, county, day), and
  running sums over ``unix_date`` per (state, county, year) give every marker
  its sums and counts.  Such a partition holds at most a row per day plus
  2 + len(days) markers per distinct harvest date, however many rows a day of
  weather or a harvest date has.  The yields are a bucketed table, read twice:
  for their probes and for the last join, in place both times.  A harvest day's yields are dealt to
  slices, and its features go to the slices that exist, so that a day that holds
  most yields is joined by many tasks.

Both return, per yield row whose county-year has any weather row and for
every N in ``days``: ``p{N}`` (rain sum; 0 when no rain value is in range but
some weather day of the county-year is out of range, null when every weather
day is in range and none has rain), ``tsum{N}``/``tcnt{N}`` (temperature sum
and count of non-null values in range) and ``hot{N}`` (days in range with
TMAX >= threshold) for the largest N.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.exprs import state_key
from fieldlens.operators.bucketing import bucketed, slice_of

SEASON = ["_s", "_k", "_y"]  # state key, county, year of one season's weather
PROBE = [*SEASON, "_h", "_slice"]  # a harvest day of a season, and a slice of its yields
SLICES = 62  # a day's slices are the bits of one long


def _weather_side(weather: DataFrame, state: str, county: str, date: str, precip: str, temp: str,
                  tmax: str) -> DataFrame:
    return weather.select(
        state_key(state).alias("_s"),
        F.col(county).alias("_k"),
        F.year(F.col(date)).alias("_y"),
        F.unix_date(F.col(date).cast("date")).alias("_d"),
        F.col(precip).alias("_p"),
        F.col(temp).alias("_t"),
        F.col(tmax).alias("_x"),
        F.lit(1).alias("_w"),
    )


def daily_weather(weather: DataFrame, *, hot_threshold: float = 95.0, w_state: str = "state_abbrev",
                  w_county: str = "county_name", w_date: str = "date", precip: str = "PRCP",
                  temp: str = "TAVG_Cleaned", tmax: str = "TMAX") -> DataFrame:
    """Weather added up per state, county and day: keys ``SEASON`` and ``_d``, the
    rows, sums and counts of rain and temperature, and the hot rows.

    Grouped by the table's own columns, so that a table that is partitioned by
    them (one row a day already) is not exchanged again.
    """
    day = F.col(w_date).cast("date")
    hot = (F.col(tmax) >= F.lit(hot_threshold)).cast("int")
    per_day = weather.groupBy(w_state, w_county, day.alias("_day")).agg(
        F.sum(F.lit(1)).alias("_w"), F.sum(precip).alias("_p"), F.count(precip).alias("_pn"),
        F.sum(temp).alias("_t"), F.count(temp).alias("_tn"), F.sum(hot).alias("_hot"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast(per_day.schema[c].dataType)).alias(c)
    return per_day.select(state_key(w_state).alias("_s"), F.col(w_county).alias("_k"), F.year("_day").alias("_y"),
                          F.unix_date("_day").alias("_d"), "_w", zero("_p"), "_pn", zero("_t"), "_tn", zero("_hot"))


def season_rows(yields: DataFrame, slice_cols: Sequence[str], *, state: str = "State", county: str = "County",
                year: str = "Year", harvest: str = "Harvest_Date") -> DataFrame:
    """``yields`` with the columns ``PROBE``: the season and harvest day each
    row asks for, and a slice number, so that the rows of one day can lie in
    many tasks."""
    return yields.withColumns({
        "_s": state_key(state), "_k": F.col(county), "_y": F.col(year),
        "_h": F.unix_date(F.col(harvest).cast("date")), "_slice": slice_of(slice_cols, SLICES)})


def season_features(rows: DataFrame, daily: DataFrame, *, days: Sequence[int] = (60, 90)) -> DataFrame:
    """(``PROBE``, p{N}, tsum{N}, tcnt{N}, hot{max N}): the look-back of every
    harvest day that occurs in ``rows``, once per slice that has it.

    ``rows`` come from :func:`season_rows`, ``daily`` from :func:`daily_weather`.
    Where ``rows`` is bucketed by ``PROBE``, only its distinct probes and their
    features are exchanged, not the yields; the weather moves once, as days.
    """
    days = sorted(int(d) for d in days)
    big = days[-1]
    sums = ["_w", "_p", "_pn", "_t", "_tn", "_hot"]
    kinds = {c: daily.schema[c].dataType for c in sums}
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weather = daily.select(*SEASON, "_d", F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_h"),
                           F.lit(None).cast("int").alias("_role"), F.lit(None).cast("bigint").alias("_slices"), *sums)
    probes = rows.select(*PROBE).distinct().repartition(n, *SEASON).groupBy(*SEASON, "_h").agg(
        F.expr("bit_or(shiftleft(1L, _slice)) AS _slices"))
    # markers: at the harvest day, before each range, and after the season's last day
    offsets = F.array(*[F.struct(F.lit(role).alias("_role"), day.cast("int").alias("_d")) for role, day in [
        (0, F.col("_h")), *[(d, F.col("_h") - (d + 1)) for d in days], (-1, F.lit(2**31 - 1))]])
    markers = probes.select(*SEASON, "_h", "_slices", F.inline(offsets)).select(
        *SEASON, "_d", F.lit(1).alias("_kind"), "_h", "_role", "_slices",
        *[F.lit(0).cast(kinds[c]).alias(c) for c in sums])
    run = (Window.partitionBy(*SEASON).orderBy("_d", "_kind")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = weather.unionByName(markers).select(
        *SEASON, "_kind", "_h", "_role", "_slices", *[F.sum(c).over(run).alias(f"_c{c}") for c in sums]).where("_kind = 1")
    # the markers of one probe share SEASON: grouping by _h too reuses the
    # window's partitioning, no exchange
    at, aggs = {}, [F.expr("max(CASE WHEN _role = -1 THEN _c_w END) AS _np"), F.expr("max(_slices) AS _slices")]
    for role in [0, *days]:
        for c in sums:
            at[(role, c)] = F.col(f"_r{role}{c}")
            aggs.append(F.expr(f"max(CASE WHEN _role = {role} THEN _c{c} END) AS _r{role}{c}"))
    per = cum.groupBy(*SEASON, "_h").agg(*aggs).where("_np > 0")

    def rng(n, c):
        return at[(0, c)] - at[(n, c)]

    out_cols = []
    for d in days:
        s = F.when(rng(d, "_pn") > 0, rng(d, "_p"))
        out_cols += [
            F.coalesce(s, F.when(F.col("_np") > rng(d, "_w"), F.lit(0).cast(kinds["_p"]))).alias(f"p{d}"),
            F.when(rng(d, "_tn") > 0, rng(d, "_t")).alias(f"tsum{d}"),
            rng(d, "_tn").cast("bigint").alias(f"tcnt{d}"),
        ]
    out_cols.append(rng(big, "_hot").cast("bigint").alias(f"hot{big}"))
    which = F.expr(f"filter(sequence(0, {SLICES - 1}), i -> (shiftright(_slices, i) & 1L) = 1)")
    return per.select(*SEASON, "_h", F.explode(which).alias("_slice"), *out_cols)


def lookback_from_seasons(rows: DataFrame, features: DataFrame) -> DataFrame:
    """``rows`` (see :func:`season_rows`) with their look-back features, without
    the ``PROBE`` columns; rows of a season without weather are dropped."""
    return rows.join(features, PROBE, "inner").drop(*PROBE)


def lookback_features(
    yields: DataFrame,
    weather: DataFrame,
    *,
    days: Sequence[int] = (60, 90),
    hot_threshold: float = 95.0,
    state: str = "State",
    county: str = "County",
    year: str = "Year",
    harvest: str = "Harvest_Date",
    w_state: str = "state_abbrev",
    w_county: str = "county_name",
    w_date: str = "date",
    precip: str = "PRCP",
    temp: str = "TAVG_Cleaned",
    tmax: str = "TMAX",
) -> DataFrame:
    """Window form of the look-back (see module doc).  Returns ``yields`` plus
    ``p{N}``, ``tsum{N}``, ``tcnt{N}`` for each N and ``hot{max N}``.

    A sliding frame is evaluated by Spark as a full re-aggregation per row
    (rows x frame work), so the frame sums are taken as differences of
    running sums instead, which Spark updates incrementally (O(rows)): every
    distinct harvest date H gets one marker at H, one at H - (N + 1) per N and
    one behind the season's end; the running totals at those markers differ by
    exactly the days H-N .. H, and the last one counts the season's rows.
    DECIMAL running sums keep the differences exact.
    """
    rows = bucketed(season_rows(yields, yields.columns, state=state, county=county, year=year, harvest=harvest),
                    PROBE, "season-yields")
    daily = daily_weather(weather, hot_threshold=hot_threshold, w_state=w_state, w_county=w_county,
                          w_date=w_date, precip=precip, temp=temp, tmax=tmax)
    return lookback_from_seasons(rows, season_features(rows, daily, days=days))


def lookback_naive(
    yields: DataFrame,
    weather: DataFrame,
    *,
    row_key: Sequence[str],
    days: Sequence[int] = (60, 90),
    hot_threshold: float = 95.0,
    state: str = "State",
    county: str = "County",
    year: str = "Year",
    harvest: str = "Harvest_Date",
    w_state: str = "state_abbrev",
    w_county: str = "county_name",
    w_date: str = "date",
    precip: str = "PRCP",
    temp: str = "TAVG_Cleaned",
    tmax: str = "TMAX",
) -> DataFrame:
    """Join-then-aggregate form, grouped by ``row_key`` (the reference's plan).

    Kept for equivalence tests and small inputs; it multiplies the yield table
    by the number of weather days per county-year before aggregating.
    """
    days = sorted(int(d) for d in days)
    big = days[-1]
    w = _weather_side(weather, w_state, w_county, w_date, precip, temp, tmax)
    y = yields.withColumns({"_hd": F.unix_date(F.col(harvest).cast("date")), "_sk": state_key(state)})
    j = y.join(w, (y["_sk"] == w["_s"]) & (y[county] == w["_k"]) & (y[year] == w["_y"]), "inner")
    b = F.col("_hd") - F.col("_d")
    aggs = []
    for n in days:
        rng = (b >= 0) & (b <= n)
        aggs += [
            F.sum(F.when(rng, F.col("_p")).otherwise(F.lit(0))).alias(f"p{n}"),
            F.sum(F.when(rng, F.col("_t"))).alias(f"tsum{n}"),
            F.count(F.when(rng, F.col("_t"))).alias(f"tcnt{n}"),
        ]
    rng = (b >= 0) & (b <= big)
    aggs.append(F.count(F.when(rng & (F.col("_x") >= F.lit(hot_threshold)), F.lit(True)))
                .alias(f"hot{big}"))
    return j.groupBy(*row_key).agg(*aggs)
