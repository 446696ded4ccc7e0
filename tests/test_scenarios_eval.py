"""Scenarios (F4 repeated keys, K14 zero baseline) and evaluation invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldlens.functions.exprs import fixed_text, pct_change, yield_status
from fieldlens.plans import evaluate as EV
from fieldlens.plans.scenarios import (
    dedupe_production, expand_scenarios, linear_score, risk_vs_baseline, risk_vs_mean_baseline, score_scenarios,
)


def test_mean_baseline_of_repeated_keys(spark):
    """the risk is the % change against the mean baseline prediction of a
    (County, Crop) whose rows repeat."""
    rows = []
    for i in range(60):
        county, crop = f"c{i % 4}", "corn" if i % 3 else "soy"
        for scenario, factor in (("Baseline (Actual)", 1.0), ("Simulated Heatwave", 0.9), ("Simulated Drought", 0.7)):
            rows.append(("OH", county, crop, scenario, (50.0 + i * 1.25) * factor))
    df = spark.createDataFrame(rows, "State string, County string, Crop string, Scenario string, Predicted_Yield double")
    got = risk_vs_mean_baseline(df, digits=None).collect()
    base = {}
    for _, county, crop, scenario, p in rows:
        if scenario == "Baseline (Actual)":
            base.setdefault((county, crop), []).append(p)
    assert len(got) == len(rows) and max(map(len, base.values())) > 3
    for r in got:
        b = base[(r["County"], r["Crop"])]
        b = sum(b) / len(b)
        assert r["Yield_Risk_%"] == pytest.approx((r["Predicted_Yield"] - b) / b * 100, rel=1e-9, abs=1e-9)


def test_zero_or_missing_baseline_gives_null(spark):
    df = spark.createDataFrame(
        [("S", "A", "c", "Baseline (Actual)", 0.0), ("S", "A", "c", "Simulated Drought", 5.0),
         ("S", "B", "c", "Simulated Drought", 5.0)],
        "State string, County string, Crop string, Scenario string, Predicted_Yield double")
    res = {(r["County"], r["Scenario"]): r["Yield_Risk_%"]
           for r in risk_vs_baseline(df).collect()}
    assert res[("A", "Simulated Drought")] is None
    assert res[("B", "Simulated Drought")] is None


def test_expand_scenarios_shifts(spark):
    df = spark.createDataFrame(
        [("A", "c", 10.0, 20.0, 100.0, 200.0, 3)],
        "County string, Crop string, `60d_Avg_Temp` double, `90d_Avg_Temp` double, "
        "`60d_Total_Precip` double, `90d_Total_Precip` double, `90d_Days_Above_95F` long")
    res = {r["Scenario"]: r for r in expand_scenarios(df).collect()}
    assert res["Simulated Heatwave"]["90d_Days_Above_95F"] == 18
    assert res["Simulated Heatwave"]["60d_Avg_Temp"] == 15.0
    assert res["Simulated Drought"]["90d_Total_Precip"] == 100.0
    assert res["Baseline (Actual)"]["60d_Total_Precip"] == 100.0


def test_status_band_edges(spark):
    """Strict inequalities; a null average is Average."""
    df = spark.createDataFrame([(105.0, 100.0), (105.01, 100.0), (95.0, 100.0), (94.99, 100.0),
                                (50.0, None)], "y double, a double")
    got = [r[0] for r in df.select(yield_status("y", "a")).collect()]
    assert got == ["Average", "Good", "Average", "Poor", "Average"]


def test_fixed_text_and_pct_change(spark):
    df = spark.createDataFrame([(12.345, 10.0, 0.0)], "x double, b double, z double")
    r = df.select(fixed_text("x", 1).alias("t"), pct_change("x", "b").alias("p"),
                  pct_change("x", "z").alias("pz")).first()
    assert r["t"] == "12.3" and r["p"] == pytest.approx(23.45) and r["pz"] is None


GOLD = ("State string, County string, Crop string, Year int, Harvest_Date date, Yield_Per_Acre decimal(18,2), "
        "`5_Year_Avg_Yield` double, `60d_Avg_Temp` double, `90d_Avg_Temp` double, `60d_Total_Precip` double, "
        "`90d_Total_Precip` double, `90d_Days_Above_95F` long")


def franklins(spark):
    """Two counties of one name in two states, with far apart yields."""
    return spark.createDataFrame(
        [(s, "Franklin", "corn", 2000, dt.date(2000, 9, d), Decimal(v), a, 70.0, 71.0, p, p, 1)
         for s, d, v, a, p in [("Ohio", 1, "100.00", 90.0, 5.0), ("Ohio", 2, "104.00", 90.0, 6.0),
                               ("Indiana", 3, "10.00", 9.0, 1.0), ("Indiana", 4, "14.00", 9.0, 2.0)]], GOLD)


def test_scenarios_keep_counties_of_one_name_apart(spark):
    first = dedupe_production(franklins(spark), [("Harvest_Date", "asc")])
    assert {(r["State"], r["Yield_Per_Acre"]) for r in first.collect()} == {
        ("Ohio", Decimal("100.00")), ("Indiana", Decimal("10.00"))}
    scored = score_scenarios(expand_scenarios(first), linear_score, (0.0, 0.0))
    got = {(r["State"], r["Scenario"]): (r["Predicted_Yield"], r["Yield_Risk_%"]) for r in risk_vs_baseline(scored).collect()}
    assert len(got) == 6
    for (state, _), (p, risk) in got.items():
        base = got[(state, "Baseline (Actual)")][0]
        assert risk == pytest.approx((p - base) / base * 100)
    mean = risk_vs_mean_baseline(score_scenarios(expand_scenarios(franklins(spark)), linear_score, (0.0, 0.0)), digits=None)
    sums = {}
    for r in mean.where("Scenario = 'Baseline (Actual)'").collect():
        sums[r["State"]] = sums.get(r["State"], 0.0) + r["Yield_Risk_%"]
    assert sums == {"Ohio": pytest.approx(0.0, abs=1e-9), "Indiana": pytest.approx(0.0, abs=1e-9)}


def test_key_means_and_yearly_means_keep_counties_of_one_name_apart(spark):
    g = franklins(spark)
    pred = EV.predict_key_mean(g, EV.fit_key_mean(g))
    assert {(r["State"], r[EV.PRED]) for r in pred.collect()} == {("Ohio", 102.0), ("Indiana", 12.0)}
    rows = EV.yearly_actual_vs_pred(pred).collect()
    assert {(r["State"], r["Avg_Yield"], r["Avg_Predicted"]) for r in rows} == {("Ohio", 102.0, 102.0), ("Indiana", 12.0, 12.0)}
    twins = g.where("State = 'Ohio'").unionByName(g.where("State = 'Ohio'").withColumn("State", F.lit("Indiana")))
    keys = twins.select(EV.row_key().alias("k")).distinct()
    assert keys.count() == 4  # equal but for the state: rows of their own
