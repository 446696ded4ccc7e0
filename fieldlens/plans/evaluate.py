"""Evaluation: splits, a deterministic baseline predictor, metrics, bands and
the grower summary (K6, K7, E6-E9, E11, K10, C14, M6).

The metric and band operators take any table with an actual and a predicted
column, so they serve the forest (``fieldlens.plans.model``) and the
key-mean baseline below alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.exprs import fixed_text, hash_bucket, pct_change
from fieldlens.operators.aggregates import exact_mean
from fieldlens.operators.quantiles import exact_quantiles, exact_quantiles_of
from fieldlens.session import materialize_observed

ROW_KEY_COLS = ["State", "County", "Crop", "Year", "Harvest_Date", "Yield_Per_Acre"]
KEYS = ("State", "County", "Crop")
TARGET = "Yield_Per_Acre"
PRED = "Predicted_Yield"


def row_key(cols: Sequence[str] = ROW_KEY_COLS) -> Column:
    """A text key of a gold row, the same text on any SQL engine."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def holdout_split(df: DataFrame, *, test_buckets: int = 5, out: str = "split") -> DataFrame:
    """K6: seeded 80/20 split by a hash of the row key (reproducible, and
    independent of partitioning, unlike ``randomSplit``)."""
    b = hash_bucket(row_key(), test_buckets, salt=0)
    return df.withColumn(out, F.when(b == 0, F.lit("test")).otherwise(F.lit("train")))


def assign_folds(df: DataFrame, *, folds: int = 5, out: str = "fold") -> DataFrame:
    """K7: fold number 0..folds-1 from independent digits of the row hash."""
    return df.withColumn(out, hash_bucket(row_key(), folds, salt=1).cast("int"))


def fit_key_mean(train: DataFrame, keys: Sequence[str] = KEYS,
                 target: str = TARGET) -> tuple[DataFrame, float | None]:
    """Baseline model: mean target per key, plus the global mean for unseen
    keys (one scalar).

    One pass over the training rows: the per-key sums and counts (one row
    per key) are written once, and their totals are observed on the way; with
    a DECIMAL target the sums are exact, so both means equal
    double(sum) / count over the rows.
    """
    sums, tot = materialize_observed(
        train.groupBy(*keys).agg(F.sum(target).alias("_s"), F.count(target).alias("_c")),
        [F.sum("_s").alias("s"), F.sum("_c").alias("c")], "key_mean")
    glob = float(tot["s"]) / float(tot["c"]) if tot["c"] else None
    per_key = sums.select(*keys, F.try_divide(F.col("_s").cast("double"),
                                              F.col("_c").cast("double")).alias("_km"))
    return per_key, glob


def predict_key_mean(df: DataFrame, model: tuple[DataFrame, float | None],
                     keys: Sequence[str] = KEYS, out: str = PRED) -> DataFrame:
    per_key, glob = model
    j = df.join(per_key, list(keys), "left")
    return j.withColumn(out, F.coalesce(F.col("_km"), F.lit(glob).cast("double"))).drop("_km")


def regression_metrics(df: DataFrame, *, actual: str = TARGET, pred: str = PRED,
                       by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """R^2, RMSE and MAE in one aggregate pass.

    ``sum((y - mean)^2)`` is taken as ``sum(y^2) - sum(y)^2 / n``, which needs
    exact sums: the actual column must be DECIMAL or integer, or small
    differences of large DOUBLE sums would cancel (TypeError).
    """
    kind = df.schema[actual].dataType.typeName()
    if kind in ("double", "float"):
        raise TypeError(f"{actual} is {kind}: cast it to DECIMAL for exact sums of squares")
    y, p = F.col(actual), F.col(pred)
    e = y.cast("double") - p
    g = df.groupBy(*by) if by else df.groupBy()
    a = g.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("_sy"),
        F.sum(y * y).alias("_syy"),
        F.sum(e * e).alias("_sse"),
        F.sum(F.abs(e)).alias("_sae"),
    )
    n = F.col("n").cast("double")
    sst = F.col("_syy").cast("double") - F.col("_sy").cast("double") * F.col("_sy").cast("double") / n
    return a.select(
        *by,
        F.col("n"),
        F.round(F.lit(1.0) - F.try_divide(F.col("_sse"), sst), digits).alias("r2"),
        F.round(F.sqrt(F.try_divide(F.col("_sse"), n)), digits).alias("rmse"),
        F.round(F.try_divide(F.col("_sae"), n), digits).alias("mae"),
    )


def residual_bands(df: DataFrame, *, actual: str = TARGET, pred: str = PRED,
                   lower: float = 0.10, upper: float = 0.90) -> tuple[float, float]:
    """10th and 90th percentile of residual = actual - predicted."""
    r = df.select((F.col(actual).cast("double") - F.col(pred)).alias("_res"))
    lo, hi = exact_quantiles(r, "_res", [lower, upper])
    return lo, hi


def add_bands(df: DataFrame, bands: tuple[float, float], *, actual: str = TARGET,
              pred: str = PRED, names=("Lower_Bound", "Upper_Bound")) -> DataFrame:
    """Band columns from the residual percentiles, and the residual."""
    lo, hi = bands
    out = df.withColumn(names[0], F.col(pred) + F.lit(lo)).withColumn(
        names[1], F.col(pred) + F.lit(hi))
    if actual in df.columns:
        out = out.withColumn("Residual", F.col(actual).cast("double") - F.col(pred))
    return out


def predictions_report(pred: DataFrame) -> DataFrame:
    """C14 + G1: the dashboard projection, ordered by prediction."""
    return pred.select(
        "County", "Crop", "Year", PRED, F.col(TARGET).alias("Actual_Yield"),
        "Lower_Bound", "Upper_Bound",
    ).orderBy(PRED, "County", "Crop", "Year", "Actual_Yield")


def yearly_actual_vs_pred(pred: DataFrame, digits: int = 6) -> DataFrame:
    """Mean actual and mean predicted yield per state, county, crop and year."""
    return pred.groupBy(*KEYS, "Year").agg(
        exact_mean(TARGET).alias("Avg_Yield"),
        F.round(F.avg(PRED), digits).alias("Avg_Predicted"),
    ).orderBy("Year", *KEYS)


# The heat-stress threshold (days above the hot limit in the 90
# days before harvest) that separates hot from normal seasons.
HEAT_DAYS = 4


def split_impact(gold: DataFrame, *, heat_days: int = HEAT_DAYS) -> DataFrame:
    """E8 + E9 + C15: for heat, rain and temperature, mean yield of the rows
    above a threshold vs. at-or-below it, and the change in percent.

    Heat splits at a fixed day count, rain and temperature at their exact
    medians; "high" is strictly greater, "low" is less-or-equal, a null
    feature is in neither half.  Both medians come from one pass, the means
    from one aggregate pass with conditional sums.
    """
    med = exact_quantiles_of(gold, {"90d_Total_Precip": [0.5], "90d_Avg_Temp": [0.5]})
    (rain_med,), (temp_med,) = med["90d_Total_Precip"], med["90d_Avg_Temp"]
    y = F.col(TARGET)

    def means(c: Column, thr):
        t = F.lit(thr).cast("double")
        return (exact_mean(F.when(c > t, y)), exact_mean(F.when(c <= t, y)))

    h_hi, h_lo = means(F.col("90d_Days_Above_95F"), float(heat_days))
    r_hi, r_lo = means(F.col("90d_Total_Precip"), rain_med)
    t_hi, t_lo = means(F.col("90d_Avg_Temp"), temp_med)
    a = gold.agg(h_hi.alias("h_hi"), h_lo.alias("h_lo"), r_hi.alias("r_hi"),
                 r_lo.alias("r_lo"), t_hi.alias("t_hi"), t_lo.alias("t_lo"))

    def row(name, thr, hi, lo):
        return F.struct(F.lit(name).alias("finding"), F.lit(thr).cast("double").alias("threshold"),
                        F.col(hi).alias("mean_high"), F.col(lo).alias("mean_low"),
                        pct_change(F.col(hi), F.col(lo)).alias("impact_pct"))

    return a.select(F.inline(F.array(
        row("heat", float(heat_days), "h_hi", "h_lo"),
        row("rain", rain_med, "r_hi", "r_lo"),
        row("temperature", temp_med, "t_hi", "t_lo"),
    )))


def grower_summary(impact: DataFrame, bands: tuple[float, float]) -> DataFrame:
    """M6 + I10: one plain-language line per finding, numbers to 1 decimal."""
    f, thr, imp = F.col("finding"), F.col("threshold"), F.col("impact_pct")
    text = (
        F.when(f == "heat", F.concat(
            F.lit("More than "), fixed_text(thr, 0),
            F.lit(" hot days in the 90 days before harvest: expected yield changes by "),
            fixed_text(imp, 1), F.lit("%.")))
        .when(f == "rain", F.concat(
            F.lit("90-day rainfall above "), fixed_text(thr, 1),
            F.lit(": yield changes by "), fixed_text(imp, 1), F.lit("% against drier seasons.")))
        .otherwise(F.concat(
            F.lit("90-day mean temperature above "), fixed_text(thr, 1),
            F.lit(": yield changes by "), fixed_text(imp, 1), F.lit("%.")))
    )
    lines = impact.select(f.alias("finding"), F.round(imp, 1).alias("value"), text.alias("message"))
    lo, hi = bands
    spark = impact.sparkSession
    band = spark.range(1).select(
        F.lit("band").alias("finding"), F.lit(None).cast("double").alias("value"),
        F.concat(F.lit("Predictions fall within "), fixed_text(F.lit(lo), 1),
                 F.when(F.lit(hi) < 0, F.lit(" to ")).otherwise(F.lit(" to +")), fixed_text(F.lit(hi), 1),
                 F.lit(" of the actual yield 80% of the time.")).alias("message"),
    )
    return lines.unionByName(band)
