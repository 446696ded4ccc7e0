"""Window form of the look-back equals the join-then-aggregate form,
on hand-made edge cases (traps T5, T7, T8, T9 and the zero-vs-null rule)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldlens.operators.lookback import lookback_features, lookback_naive
from fieldlens.plans import gold as G
from fieldlens.plans.gold import gold_features
from fieldlens.session import materialize

D = dt.date


def weather(spark, rows):
    return spark.createDataFrame(
        rows, "county_name string, date date, PRCP decimal(18,2), TAVG_Cleaned double, TMAX double"
    ).withColumn("state_abbrev", F.lit("OH"))


def yields(spark, rows):
    return spark.createDataFrame(rows, "yid long, County string, Year int, Harvest_Date date").withColumn(
        "State", F.lit("Ohio"))


CASES = {
    # harvest inside the year, days exactly 0, 60, 61, 90, 91 before
    "bounds": ([("A", D(2001, 1, 1) + dt.timedelta(d), Decimal("1.00"), 10.0, 100.0)
                for d in range(0, 200)],
               [(1, "A", 2001, D(2001, 5, 1))]),
    # harvest in the next year: only this year's late days count
    "next_year": ([("A", D(2001, 12, 1), Decimal("2.00"), 5.0, 99.0),
                   ("A", D(2001, 6, 1), Decimal("3.00"), 5.0, 99.0)],
                  [(1, "A", 2001, D(2002, 1, 15))]),
    # harvest before the year starts: no day in range, sums 0, means null
    "before_year": ([("A", D(2001, 3, 1), Decimal("2.00"), 5.0, 99.0)],
                    [(1, "A", 2001, D(2000, 12, 31))]),
    # every weather day in range and all rain null -> null, not 0
    "all_in_range_null_rain": ([("A", D(2001, 3, 1), None, 5.0, 99.0),
                                ("A", D(2001, 3, 2), None, None, None)],
                               [(1, "A", 2001, D(2001, 3, 10))]),
    # some day out of range, in-range rain null -> 0
    "zero_not_null": ([("A", D(2001, 3, 1), None, 5.0, 99.0),
                       ("A", D(2001, 1, 1), Decimal("7.00"), 5.0, 99.0)],
                      [(1, "A", 2001, D(2001, 3, 10))]),
    # county-year without weather is dropped (inner join)
    "no_weather": ([("A", D(2001, 3, 1), Decimal("1.00"), 5.0, 99.0)],
                   [(1, "B", 2001, D(2001, 3, 10)), (2, "A", 2002, D(2002, 3, 10))]),
    # null TMAX never hot; several yields share a harvest date
    "shared_dates": ([("A", D(2001, 3, d), Decimal("1.50"), None if d % 2 else 1.0,
                       None if d % 3 == 0 else 100.0) for d in range(1, 28)],
                     [(1, "A", 2001, D(2001, 3, 20)), (2, "A", 2001, D(2001, 3, 20)),
                      (3, "A", 2001, D(2001, 3, 27))]),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_window_equals_naive(spark, case):
    w_rows, y_rows = CASES[case]
    w, y = weather(spark, w_rows), yields(spark, y_rows)
    a = lookback_features(y, w, hot_threshold=95.0).drop("State", "County", "Year", "Harvest_Date")
    b = lookback_naive(y, w, row_key=["yid"], hot_threshold=95.0)
    ra = {r["yid"]: r.asDict() for r in a.collect()}
    rb = {r["yid"]: r.asDict() for r in b.collect()}
    assert ra == rb


def test_inclusive_bounds_counts(spark):
    w_rows, y_rows = CASES["bounds"]
    r = lookback_features(yields(spark, y_rows), weather(spark, w_rows), hot_threshold=95.0).first()
    assert r["tcnt60"] == 61 and r["tcnt90"] == 91 and r["hot90"] == 91
    assert r["p60"] == Decimal("61.00")


def test_duplicate_yield_rows_double_sums(spark):
    """Rows identical in the 8 group keys collapse into one gold row whose
    rain sums and hot-day counts scale with the copies (the mean temperature
    does not).  Seven identical yields: the first has a null trailing
    average; the other six share average 5.0 and collapse (x6)."""
    y = spark.createDataFrame(
        [(i, "A", "S", "corn", 2001, D(2001, 3, 10), Decimal("5.00")) for i in range(1, 8)],
        "yield_id long, County string, State string, Crop string, Year int, "
        "Harvest_Date date, Yield_Per_Acre decimal(18,2)")
    w = spark.createDataFrame(
        [("A", D(2001, 3, 1), Decimal("2.00"), 10.0, 100.0, 50.0)],
        "county_name string, date date, PRCP decimal(18,2), TAVG double, TMAX double, TMIN double"
    ).withColumn("state_abbrev", F.lit("S"))
    g = {r["5_Year_Avg_Yield"]: r for r in
         gold_features(y, w, tiebreak=("Harvest_Date", "yield_id")).collect()}
    assert set(g) == {None, 5.0}
    assert g[None]["Yield_Status"] == "Average" and g[None]["60d_Total_Precip"] == 2.0
    r = g[5.0]
    assert r["60d_Total_Precip"] == 12.0
    assert r["90d_Days_Above_95F"] == 6
    assert r["60d_Avg_Temp"] == 10.0


def test_temperature_falls_back_to_midpoint(spark):
    y = spark.createDataFrame(
        [(1, "A", "S", "corn", 2001, D(2001, 3, 10), Decimal("5.00"))],
        "yield_id long, County string, State string, Crop string, Year int, "
        "Harvest_Date date, Yield_Per_Acre decimal(18,2)")
    w = spark.createDataFrame(
        [("A", D(2001, 3, 1), Decimal("2.00"), None, 100.0, 50.0),
         ("A", D(2001, 3, 2), Decimal("2.00"), None, None, 50.0)],
        "county_name string, date date, PRCP decimal(18,2), TAVG double, TMAX double, TMIN double"
    ).withColumn("state_abbrev", F.lit("S"))
    r = gold_features(y, w, tiebreak=("Harvest_Date", "yield_id")).first()
    assert r["60d_Avg_Temp"] == 75.0  # the second day has no temperature at all
    assert r["90d_Days_Above_95F"] == 1


def test_counties_of_the_same_name_stay_apart(spark):
    """Franklin in two states, one side with full names: rain, averages and
    joined days never mix; target pairs reduce both tables alike."""
    from fieldlens.operators.joins import yield_weather_days

    y = spark.createDataFrame(
        [(i, "Franklin", s, "corn", yr, D(yr, 3, 10), Decimal(v))
         for i, (s, yr, v) in enumerate([("Ohio", 2001, "100.00"), ("Ohio", 2002, "1.00"), ("Indiana", 2001, "10.00"),
                                         ("Indiana", 2002, "2.00")])],
        "yield_id long, County string, State string, Crop string, Year int, "
        "Harvest_Date date, Yield_Per_Acre decimal(18,2)")
    w = spark.createDataFrame(
        [("OH", "Franklin", D(2002, 3, 1), Decimal("1.00"), 10.0, 100.0, 50.0),
         ("OH", "Franklin", D(2002, 3, 1), Decimal("0.50"), 20.0, 100.0, 50.0),
         ("IN", "Franklin", D(2002, 3, 2), Decimal("50.00"), 30.0, 90.0, 50.0)],
        "state_abbrev string, county_name string, date date, PRCP decimal(18,2), TAVG double, TMAX double, TMIN double")
    tie = ("Harvest_Date", "yield_id")
    g = {r["State"]: r for r in gold_features(y, w, tiebreak=tie).where("Year = 2002").collect()}
    assert g["Ohio"]["60d_Total_Precip"] == 1.5 and g["Indiana"]["60d_Total_Precip"] == 50.0
    assert g["Ohio"]["5_Year_Avg_Yield"] == 100.0 and g["Indiana"]["5_Year_Avg_Yield"] == 10.0
    assert g["Ohio"]["60d_Avg_Temp"] == 15.0  # two rows of one day add up
    days = {r["State"]: r["weather_days"] for r in yield_weather_days(y, w).collect()}
    assert days == {"Ohio": 2, "Indiana": 1}
    only = gold_features(y, w, tiebreak=tie, pairs=[("Franklin", "Ohio")]).where("Year = 2002").collect()
    assert [r["State"] for r in only] == ["Ohio"] and only[0]["60d_Total_Precip"] == 1.5


def test_seasons_meet_in_their_buckets_and_a_busy_day_is_split(spark):
    """The gold plan: one window, the yields read from their buckets without an
    exchange of their own; the yields of one harvest day lie in many files."""
    from fieldlens.operators import lookback as L
    from fieldlens.operators.bucketing import bucketed

    y = spark.range(400).select(F.col("id").alias("yid"), F.lit("A").alias("County"), F.lit("Ohio").alias("State"),
                                F.lit(2001).alias("Year"), F.lit(D(2001, 5, 1)).alias("Harvest_Date"))
    w = weather(spark, CASES["bounds"][0])
    rows = bucketed(L.season_rows(y, ["yid"]), L.PROBE, "busy")
    assert len(rows.inputFiles()) > 4
    out = L.lookback_from_seasons(rows, L.season_features(rows, L.daily_weather(w)))
    assert out.count() == 400 and {r["p60"] for r in out.collect()} == {Decimal("61.00")}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from fieldlens.plans.registry import QUERIES

        plan = QUERIES["gold_features"](spark, "/root/testdata/sf0.001")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = [part for part in text.split("FileScan parquet spark_catalog")[1:]]
    assert len(scans) == 2 and all("Bucketed: true" in s for s in scans)
    assert text.count("Window [") + text.count("Window(") == 1
    join = text.split("SortMergeJoin")[1].split("Exchange")[0]
    assert "HashAggregate" in join  # the yields' side: aggregated and sorted in place


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_seasons_known_at_run_time_prune_years_and_rows(spark):
    """The years of a filtered season table prune the partitions that are read;
    where both sides shuffle, a Bloom filter of the keys goes before the exchange."""
    rows = [(f"c{i % 40}", "Ohio", 1990 + i % 10, i) for i in range(4000)] + [(None, "Ohio", 1999, -1), ("c1", None, 1999, -2)]
    gold = materialize(spark.createDataFrame(rows, "County string, State string, Year int, v int"), "t-gold", partition_by=["Year"])
    seasons = materialize(spark.createDataFrame(
        [(f"c{i}", "OH" if i != 3 else "IN", 1990 + y, 100 * y + i) for i in range(40) for y in range(10)] + [(None, "OH", 1999, 999)],
        "County string, State string, Year int, days int"), "t-seasons")
    got = G.of_seasons(gold, seasons.where("days > 899"), "days")
    want = sorted((c, s, 1999, v, 900 + int(c[1:])) for c, s, y, v in rows if y == 1999 and c and s and c != "c3")
    assert sorted((r.County, r.State, r.Year, r.v, r.days) for r in got.collect()) == want and want
    assert "dynamicpruning" in plan_of(got).lower()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        shuffled = G.of_seasons(gold, seasons.where("days > 899"), "days")
        assert sorted((r.County, r.State, r.Year, r.v, r.days) for r in shuffled.collect()) == want
        assert "might_contain" in plan_of(shuffled).lower()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
