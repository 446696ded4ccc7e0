"""M4: what-if scenarios scored against a baseline.

Scenarios are a literal table of shifts applied by a generator (``inline``)
to every production row, so the three copies come from one scan, with no
union of three plans and no join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.exprs import pct_change
from fieldlens.operators.windows import first_per_key

# Scenario names and shifts (hot days added, degrees added to
# both mean temperatures, factor on both rain totals).
BASELINE = "Baseline (Actual)"
SCENARIOS = [
    (BASELINE, 0, 0.0, 1.0),
    ("Simulated Heatwave", 15, 5.0, 1.0),
    ("Simulated Drought", 0, 0.0, 0.5),
]

PRED = "Predicted_Yield"
KEYS = ["State", "County", "Crop"]


def dedupe_production(prod: DataFrame, order: Sequence[tuple]) -> DataFrame:
    """one row per (State, County, Crop) under a stated order."""
    return first_per_key(prod, KEYS, order)


def expand_scenarios(df: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """C13 + H1: every row once per scenario, with its features shifted."""
    arr = F.array(*[
        F.struct(F.lit(n).alias("Scenario"), F.lit(d).cast("bigint").alias("_dd"),
                 F.lit(t).cast("double").alias("_dt"), F.lit(m).cast("double").alias("_mp"))
        for n, d, t, m in scenarios
    ])
    x = df.select("*", F.inline(arr))
    return x.withColumns({
        "90d_Days_Above_95F": F.col("90d_Days_Above_95F") + F.col("_dd"),
        "60d_Avg_Temp": F.col("60d_Avg_Temp") + F.col("_dt"),
        "90d_Avg_Temp": F.col("90d_Avg_Temp") + F.col("_dt"),
        "60d_Total_Precip": F.col("60d_Total_Precip") * F.col("_mp"),
        "90d_Total_Precip": F.col("90d_Total_Precip") * F.col("_mp"),
    }).drop("_dd", "_dt", "_mp")


# Fixed coefficients of the linear stand-in score used where an exact oracle
# is wanted; the forest (fieldlens.plans.model) is the real scorer.
LINEAR = [("60d_Total_Precip", 2.0), ("90d_Total_Precip", 1.0), ("60d_Avg_Temp", -0.25),
          ("90d_Avg_Temp", -0.25), ("90d_Days_Above_95F", -100.0)]


def linear_score(df: DataFrame, out: str = PRED) -> DataFrame:
    s = F.coalesce(F.col("5_Year_Avg_Yield"), F.lit(0.0))
    for c, w in LINEAR:
        s = s + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.withColumn(out, s)


def score_scenarios(expanded: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                    bands: tuple[float, float]) -> DataFrame:
    """Score every scenario row once and attach the confidence bounds."""
    s = scorer(expanded)
    lo, hi = bands
    return s.select(
        *KEYS, "Yield_Per_Acre", "Scenario", F.col(PRED),
        (F.col(PRED) + F.lit(lo)).alias("Lower_Confidence_Bound"),
        (F.col(PRED) + F.lit(hi)).alias("Upper_Confidence_Bound"),
    )


def risk_vs_baseline(scored: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """K14 + D5: % change of each prediction against the baseline prediction
    of its (State, County, Crop).  Rows are unique per key and scenario here, so the
    window holds one row per scenario (bounded)."""
    w = Window.partitionBy(*KEYS)
    base = F.max(F.when(F.col("Scenario") == baseline, F.col(PRED))).over(w)
    return scored.withColumn("Yield_Risk_%", pct_change(F.col(PRED), base))


def risk_vs_mean_baseline(scored: DataFrame, digits: int | None = 6,
                          baseline: str = BASELINE) -> DataFrame:
    """% change against the *mean* baseline prediction of the key, for
    tables where a key repeats.  The mean is a partial aggregate joined back,
    so a hot key is reduced map-side instead of filling one window task."""
    b = scored.where(F.col("Scenario") == baseline).groupBy(*KEYS).agg(
        F.avg(PRED).alias("_base"))
    j = scored.join(b, KEYS, "left")
    risk = pct_change(F.col(PRED), F.col("_base"))
    if digits is not None:
        risk = F.round(risk, digits)
    return j.withColumn("Yield_Risk_%", risk).drop("_base")
