"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables through the analog views, so its work
grows with the data.  Parameters chosen for the analog data (years, the hot
threshold) are listed once below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.exprs import clean_temperature, dict_lookup, geoid
from fieldlens.operators.aggregates import group_mean_long, pivot_mean
from fieldlens.operators.filters import drop_null_rows, pair_filter, semi_filter, year_split
from fieldlens.operators.joins import left_join_dim, yield_weather_days
from fieldlens.operators.lookback import lookback_features, lookback_naive
from fieldlens.operators.quantiles import RANK_ERROR, quantile_row, sketch_quantiles, write_sketches
from fieldlens.operators.setops import stack, top_k
from fieldlens.operators.spatial import points_in_cover, polygon_cover
from fieldlens.operators.windows import first_per_key
from fieldlens.plans import evaluate as EV
from fieldlens.plans import gold as G
from fieldlens.plans import model as M
from fieldlens.plans import scenarios as SC
from fieldlens.plans import weather as WB
from fieldlens.schemas import OBSERVATION_RECORD, STATION_RECORD, WEATHER_NO_CODES, YIELD_CSV
from fieldlens.session import checkpoint_root, materialize, shared_path, unique_name
from fieldlens.sources import analogs as A
from fieldlens.sources import files as FS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Analog parameters: order dates run 1995..2001; the extended price plays the
# part of a temperature, so the hot-day threshold is on that scale.
TIEBREAK = ("Harvest_Date", "yield_id")
HOT = 90000.0
TEMP_TYPE = "decimal(18,3)"
TRAIN_MAX_YEAR = 1999
HOLDOUT_YEAR = 2000


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("rolling_yield")
def q_rolling_yield(spark, base):
    y = G.add_trailing_yield(A.yield_view(spark, base), tiebreak=TIEBREAK)
    return y.select("yield_id", "County", "Crop", "Year", "Harvest_Date", "Yield_Per_Acre",
                    G.AVG_COL)


@register("yield_status")
def q_yield_status(spark, base):
    y = G.add_trailing_yield(A.yield_view(spark, base), tiebreak=TIEBREAK)
    return y.select("yield_id", "County", "Crop", "Year", G.STATUS_COL)


def _lookback_out(df: DataFrame) -> DataFrame:
    def mean(n):
        return F.when(F.col(f"tcnt{n}") > 0,
                      F.col(f"tsum{n}").cast("double") / F.col(f"tcnt{n}").cast("double"))

    return df.select(
        "yield_id",
        F.col("p60").cast("double").alias("p60"), mean(60).alias("t60"),
        F.col("p90").cast("double").alias("p90"), mean(90).alias("t90"),
        F.col("hot90").cast("bigint").alias("hot90"),
    )


@register("preharvest_features")
def q_preharvest_features(spark, base):
    y = A.yield_view(spark, base)
    w = G.clean_weather(A.weather_view(spark, base), TEMP_TYPE)
    return _lookback_out(lookback_features(y, w, hot_threshold=HOT))


@register("preharvest_naive")
def q_preharvest_naive(spark, base):
    y = A.yield_view(spark, base)
    w = G.clean_weather(A.weather_view(spark, base), TEMP_TYPE)
    return _lookback_out(lookback_naive(y, w, row_key=["yield_id"], hot_threshold=HOT))


def gold_analog(spark: SparkSession, base: str) -> DataFrame:
    """The flagship gold table over the analog views (the trailing window writes the
    yields in blocks, the labelled rows are written once in buckets)."""
    return G.gold_features(A.yield_view(spark, base), A.weather_view(spark, base),
                           tiebreak=TIEBREAK, hot_threshold=HOT, temp_type=TEMP_TYPE)


@register("gold_features")
def q_gold_features(spark, base):
    return gold_analog(spark, base)


# --------------------------------------------------------------------------
# Relational building blocks
# --------------------------------------------------------------------------

# Analog parameters: three (County, State) targets, three 5-digit keys, a
# crop-name dictionary with two misses, and the top-k size.
PAIRS = [("NATION_1", "AMERICA"), ("NATION_6", "AMERICA"), ("NATION_0", "AFRICA")]
TARGET_GEOIDS = ["03156", "16048", "10495"]
CROP_NAMES = {"1-URGENT": "Corn", "2-HIGH": "Soybeans", "3-MEDIUM": "Wheat"}
TOP_K = 10
GEOID_NAMES = {"c_name": "county_name", "c_mktsegment": "state_abbrev",
               "STATEFP": "state_fips", "COUNTYFP": "county_fips"}
GRID_CELL = 10.0


@register("pair_filter")
def q_pair_filter(spark, base):
    y = pair_filter(A.yield_view(spark, base), PAIRS, ["County", "State"])
    return y.select("yield_id", "County", "State", "Crop", "Year", "Yield_Per_Acre")


@register("pair_semi_filter")
def q_pair_semi_filter(spark, base):
    """C1, general form: the target pairs are a table (here the counties of one
    state, taken from the county dimension), applied as a left-semi join."""
    targets = A.county_view(spark, base).where(F.col("state_abbrev") == "AMERICA").select(
        F.col("county_name").alias("County"), F.col("state_abbrev").alias("State"))
    y = semi_filter(A.yield_view(spark, base), targets, ["County", "State"])
    return y.select("yield_id", "County", "State", "Crop", "Year", "Yield_Per_Acre")


@register("temp_clean")
def q_temp_clean(spark, base):
    w = A.weather_view(spark, base)
    return w.select("state_abbrev", "county_name", "date", "TAVG", "TMAX", "TMIN",
                    clean_temperature().alias("TAVG_Cleaned"))


@register("dropna_subset")
def q_dropna_subset(spark, base):
    return drop_null_rows(gold_analog(spark, base), [G.AVG_COL, "60d_Avg_Temp"])


@register("gold_target_pairs")
def q_gold_target_pairs(spark, base):
    """M2 as composed for a list of target counties: the pairs reduce both
    tables before the window and the join."""
    return G.gold_features(A.yield_view(spark, base), A.weather_view(spark, base), tiebreak=TIEBREAK,
                           hot_threshold=HOT, temp_type=TEMP_TYPE, pairs=PAIRS)


@register("year_split")
def q_year_split(spark, base):
    r = Run(spark, base)  # gold is written once, both halves prune its years
    return stack([r.train.withColumn("split", F.lit("train")),
                  r.production.withColumn("split", F.lit("holdout"))])


@register("split_tables")
def q_split_tables(spark, base):
    """The training and production halves saved as tables and read back."""
    r = Run(spark, base)
    return stack([_saved(spark, part, name).withColumn("saved_as", F.lit(name))
                  for name, part in (("training", r.train), ("production", r.production))])


@register("geoid_key")
def q_geoid_key(spark, base):
    c = A.read_table(spark, base, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATEFP"),
        F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0").alias("COUNTYFP"),
    )
    c = c.withColumn("GEOID", geoid("STATEFP", "COUNTYFP"))
    return c.where(F.col("GEOID").isin(TARGET_GEOIDS)).withColumnsRenamed(GEOID_NAMES)


@register("geoid_all")
def q_geoid_all(spark, base):
    """The key and the renaming over every row."""
    c = A.read_table(spark, base, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATEFP"),
        F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0").alias("COUNTYFP"),
    )
    return c.withColumn("GEOID", geoid("STATEFP", "COUNTYFP")).withColumnsRenamed(GEOID_NAMES)


@register("map_lookup")
def q_map_lookup(spark, base):
    y = A.yield_view(spark, base)
    return y.select("yield_id", "Crop", dict_lookup("Crop", CROP_NAMES).alias("Crop_Name"))


@register("yield_weather_join")
def q_yield_weather_join(spark, base):
    j = yield_weather_days(A.yield_view(spark, base), A.weather_view(spark, base))
    return j.select("yield_id", "County", "Year", "weather_days", "first_day", "last_day",
                    F.make_date("Year", F.lit(1), F.lit(1)).alias("season_start"))


@register("union_missing")
def q_union_missing(spark, base):
    """H2: two whole tables of different columns, missing ones null."""
    a = A.yield_view(spark, base).select("yield_id", "County", "Crop", "Year", "Yield_Per_Acre")
    b = A.weather_view(spark, base).select(F.col("county_name").alias("County"),
                                           F.col("state_abbrev").alias("State"), "date", "PRCP")
    return stack([a, b], allow_missing=True)


FIRST_ORDER = [("Harvest_Date", "asc"), ("Yield_Per_Acre", "asc"), (G.AVG_COL, "asc"),
               (G.STATUS_COL, "asc"), ("Year", "asc")]


@register("first_per_key")
def q_first_per_key(spark, base):
    return first_per_key(Run(spark, base).production, SC.KEYS, FIRST_ORDER)


@register("topk")
def q_topk(spark, base):
    y = A.yield_view(spark, base)
    return top_k(y, [F.col("Yield_Per_Acre").desc(), F.col("yield_id").asc()], TOP_K).select(
        "yield_id", "County", "Crop", "Year", "Yield_Per_Acre")


@register("table_roundtrip")
def q_table_roundtrip(spark, base):
    return _saved(spark, A.yield_view(spark, base), "bronze_yield", partition_by=["Year"])


def _saved(spark, df: DataFrame, name: str, partition_by=()) -> DataFrame:
    """B1: ``df`` saved under a table name of its own run and read back."""
    return FS.save_table(df, unique_name(name), shared_path(spark, name), partition_by=partition_by)


@register("table_overwrite_schema")
def q_table_overwrite_schema(spark, base):
    """B2: the same table name overwritten with other columns."""
    y, name = A.yield_view(spark, base), unique_name("yields")
    FS.save_table(y, name, shared_path(spark, name), partition_by=["Year"])
    FS.save_table(y.select("yield_id", F.col("Crop").alias("crop_code"), F.col("Year").cast("string").alias("Year"),
                           (F.col("Yield_Per_Acre") * 2).cast("decimal(18,2)").alias("doubled")),
                  name, shared_path(spark, name))
    return spark.table(name)


@register("csv_export")
def q_csv_export(spark, base):
    path = FS.write_csv(A.weather_view(spark, base), shared_path(spark, "weather_csv"))
    return FS.read_csv(spark, path, WEATHER_NO_CODES)


@register("csv_ingest")
def q_csv_ingest(spark, base):
    """M1: the landed file has another column order, a column nobody asked for
    and dates with a time; columns are picked by name."""
    y = A.yield_view(spark, base).select(
        "Yield_Per_Acre", F.lit("x").alias("Remark"), F.date_format("Harvest_Date", "yyyy-MM-dd'T'HH:mm:ss")
        .alias("Harvest_Date"), "Year", "Crop", "State", "County", "yield_id")
    landed = FS.write_csv(y, shared_path(spark, "yield_csv"))
    return _saved(spark, FS.read_csv(spark, landed, YIELD_CSV), "bronze_yield_csv")


@register("csv_rejects")
def q_csv_rejects(spark, base):
    """M1 with a quarantine: records with an unreadable yield or date (planted by
    id) are rejected with the fields at fault, the others land."""
    k = F.col("yield_id")
    y = A.yield_view(spark, base).select(
        "yield_id", "County", "State", "Crop", "Year",
        F.when(k % 101 == 0, F.lit("unknown")).otherwise(F.date_format("Harvest_Date", "yyyy-MM-dd")).alias("Harvest_Date"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("Yield_Per_Acre").cast("string")).alias("Yield_Per_Acre"))
    landed = FS.write_csv(y, shared_path(spark, "dirty_csv"))
    good, bad = FS.land_csv(spark, landed, YIELD_CSV, unique_name("bronze_clean"), shared_path(spark, "landed"), max_share=0.1)
    cols = ["yield_id", "County", "Year", "Harvest_Date", "Yield_Per_Acre"]
    return stack([good.select(*cols, F.lit("").alias("rejected_fields")),
                  bad.select(*cols, F.col("_fields").alias("rejected_fields"))])


# --------------------------------------------------------------------------
# Weather build
# --------------------------------------------------------------------------

# Analog datatypes: the five event types plus one that never occurs.
OBS_TYPES = ["click", "error", "purchase", "signup", "view", "TSUN"]
PAGE_SIZE = 500


@register("json_pages_flatten")
def q_json_pages_flatten(spark, base):
    ev = A.read_table(spark, base, "events")
    recs = ev.select(
        F.floor(F.col("event_id") / PAGE_SIZE).alias("page"),
        F.col("ts").cast("date").cast("string").alias("date"),
        F.col("event_type").alias("datatype"),
        F.col("user_id").cast("string").alias("station"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    path = FS.write_pages(recs, shared_path(spark, "obs_pages"), page_of="page",
                          record_cols=["date", "datatype", "station", "value"])
    return FS.read_pages(spark, path, OBSERVATION_RECORD)


def located_stations(spark, base):
    return WB.stations_in_counties(A.station_view(spark, base), A.county_edge_view(spark, base),
                                   cell=GRID_CELL)


@register("station_county")
def q_station_county(spark, base):
    return located_stations(spark, base).select("geoid", "id")


@register("station_county_cover")
def q_station_county_cover(spark, base):
    """D3 by a written cover of the counties: cells sized from each polygon, no
    ray test in inner ones."""
    edges = A.county_edge_view(spark, base)
    return points_in_cover(A.station_view(spark, base), edges, polygon_cover(edges))


@register("best_per_group")
def q_best_per_group(spark, base):
    return WB.best_station_per_county(located_stations(spark, base))


def best_station_dim(spark, base):
    best = WB.best_station_per_county(located_stations(spark, base))
    return best.withColumn("station_key", F.substring("id", 10, 64))


@register("dim_left_join")
def q_dim_left_join(spark, base):
    dim = best_station_dim(spark, base).join(A.county_view(spark, base), "geoid")
    return left_join_dim(A.observation_view(spark, base), dim, left_on="station",
                         right_on="station_key", dim_cols=["county_name", "state_abbrev"])


@register("daily_mean_long")
def q_daily_mean_long(spark, base):
    return group_mean_long(A.observation_view(spark, base), ["station", "date", "datatype"])


@register("daily_pivot")
def q_daily_pivot(spark, base):
    return pivot_mean(A.observation_view(spark, base), ["station", "date"], "datatype", OBS_TYPES)


@register("weather_build")
def q_weather_build(spark, base):
    return WB.county_day_weather(A.observation_view(spark, base), best_station_dim(spark, base),
                                   A.county_view(spark, base), station_key="station_key",
                                   datatypes=OBS_TYPES)


@register("weather_from_pages")
def q_weather_from_pages(spark, base):
    """M5 end to end: landed station pages and observation pages -> stations in
    counties -> one station per target county (each observation tagged with
    its page's station) -> wide county days -> CSV, read back by name."""
    stations = A.station_view(spark, base).withColumn(
        "page", F.floor(F.substring("id", 10, 64).cast("bigint") / PAGE_SIZE))
    st_path = FS.write_pages(stations, shared_path(spark, "station_pages"), page_of="page",
                             record_cols=["id", "latitude", "longitude", "datacoverage"])
    located = WB.stations_in_counties(FS.read_pages(spark, st_path, STATION_RECORD),
                                      A.county_edge_view(spark, base), cell=GRID_CELL)
    counties = A.county_view(spark, base)
    targets = counties.select("geoid").where(F.col("state_abbrev") != "ASIA")
    best = WB.best_station_per_county(located.join(targets, "geoid", "left_semi")).withColumn(
        "station_key", F.substring("id", 10, 64))
    obs = A.read_table(spark, base, "events").select(
        F.floor(F.col("event_id") / PAGE_SIZE).alias("page"), F.col("user_id").cast("string").alias("station"),
        F.col("ts").cast("date").cast("string").alias("date"), F.col("event_type").alias("datatype"),
        F.col("value").cast("decimal(18,2)").alias("value"))
    ob_path = FS.write_pages(obs, shared_path(spark, "obs_pages"), page_of="page",
                             record_cols=["date", "datatype", "value"], tag_cols=["station"])
    records = FS.read_pages(spark, ob_path, T.StructType([f for f in OBSERVATION_RECORD if f.name != "station"]),
                            extra=[T.StructField("station", T.StringType())])
    records = records.withColumn("date", F.col("date").cast("date")).withColumn(
        "value", F.col("value").cast("decimal(18,2)"))
    wide = WB.county_day_weather(records, best, counties, station_key="station_key", datatypes=OBS_TYPES)
    path = FS.write_csv(wide, shared_path(spark, "county_daily_weather"))
    kind = T.StructType([T.StructField(c, T.DateType() if c == "date" else T.StringType() if c in WB.COUNTY_KEYS
                                       else T.DoubleType()) for c in wide.columns])
    return FS.read_csv(spark, path, kind)


# --------------------------------------------------------------------------
# Evaluation on a deterministic predictor (K6, K7, E6-E9, E11, K10, C14, M6,
# K1, K2)
# --------------------------------------------------------------------------


@register("weather_from_station_files")
def q_weather_from_station_files(spark, base):
    """M5 from pages that lie in a folder per station: a record's station comes
    from its page's path, the pages do not name it."""
    best = best_station_dim(spark, base)
    obs = A.read_table(spark, base, "events").select(
        F.floor(F.col("event_id") / PAGE_SIZE).alias("page"), F.col("user_id").cast("string").alias("station"),
        F.col("ts").cast("date").cast("string").alias("date"), F.col("event_type").alias("datatype"),
        F.col("value").cast("decimal(18,2)").alias("value"))
    # pages are fetched for the chosen stations
    asked = obs.join(best.select(F.col("station_key").alias("station")), "station", "left_semi")
    path = FS.write_pages(asked, shared_path(spark, "station_files"), page_of="page",
                          record_cols=["date", "datatype", "value"], tag_cols=["station"], folders=True)
    records = FS.read_pages(spark, path, T.StructType([f for f in OBSERVATION_RECORD if f.name != "station"]), tag="station")
    records = records.withColumn("date", F.col("date").cast("date")).withColumn(
        "value", F.col("value").cast("decimal(18,2)"))
    return WB.county_day_weather(records, best, A.county_view(spark, base), station_key="station_key", datatypes=OBS_TYPES)


class Run:
    """Intermediate tables of one query invocation, each built (and, where it
    feeds several actions, written to the shared folder) at most once."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self._c = spark, base, {}

    def once(self, name, fn):
        if name not in self._c:
            self._c[name] = fn()
        return self._c[name]

    @property
    def gold(self) -> DataFrame:
        return self.once("gold", lambda: materialize(gold_analog(self.spark, self.base), "gold",
                                                     partition_by=["Year"]))

    @property
    def train(self) -> DataFrame:
        return self.once("train", lambda: year_split(
            self.gold, train_max_year=TRAIN_MAX_YEAR, holdout_year=HOLDOUT_YEAR)[0])

    @property
    def production(self) -> DataFrame:
        return self.once("prod", lambda: year_split(
            self.gold, train_max_year=TRAIN_MAX_YEAR, holdout_year=HOLDOUT_YEAR)[1])

    @property
    def split(self) -> DataFrame:
        return self.once("split", lambda: EV.holdout_split(self.train))

    @property
    def key_mean(self):
        """(train part, test part) with key-mean predictions."""
        def build():
            s = self.split
            tr, te = s.where("split = 'train'"), s.where("split = 'test'")
            model = EV.fit_key_mean(tr)
            return (EV.predict_key_mean(tr, model),
                    materialize(EV.predict_key_mean(te, model), "pred_test"))
        return self.once("key_mean", build)

    @property
    def bands(self):
        return self.once("bands", lambda: EV.residual_bands(self.key_mean[1]))

    def scenarios(self, dedupe: bool = True) -> DataFrame:
        prod = self.production
        if dedupe:
            prod = SC.dedupe_production(prod, FIRST_ORDER)
        return SC.expand_scenarios(prod)


OPEN_BEFORE = 12  # a season is open while its weather ends before this month


@register("gold_open_seasons")
def q_gold_open_seasons(spark, base):
    """M2 read back for the seasons whose weather is not complete: gold's years
    are pruned by a table that is only known at run time."""
    seasons = materialize(G.season_table(A.weather_view(spark, base)), "seasons")
    picked = seasons.where(F.month("last_day") < OPEN_BEFORE)
    return G.of_seasons(Run(spark, base).gold, picked, "last_day")


@register("yields_of_open_seasons")
def q_yields_of_open_seasons(spark, base):
    """D1 for the same seasons over the bronze yields."""
    bronze = _saved(spark, A.yield_view(spark, base), "bronze_yield", partition_by=["Year"])
    seasons = materialize(G.season_table(A.weather_view(spark, base)), "seasons")
    picked = seasons.where(F.month("last_day") < OPEN_BEFORE)
    return G.of_seasons(bronze, picked, "days", "rain").select(
        "yield_id", "County", "State", "Crop", "Year", "Yield_Per_Acre", "days", F.col("rain").cast("double").alias("rain"))


@register("holdout_split")
def q_holdout_split(spark, base):
    return Run(spark, base).split.select(*G.GOLD_KEYS, "split")


@register("fold_assign")
def q_fold_assign(spark, base):
    tr = Run(spark, base).split.where("split = 'train'")
    return EV.assign_folds(tr).select(*G.GOLD_KEYS, "fold")


@register("regression_metrics")
def q_regression_metrics(spark, base):
    tr, te = Run(spark, base).key_mean
    return EV.regression_metrics(stack([tr, te]), by=["split"])


@register("residual_bands")
def q_residual_bands(spark, base):
    _, te = Run(spark, base).key_mean
    r = te.select((F.col("Yield_Per_Acre").cast("double") - F.col(EV.PRED)).alias("res"))
    return quantile_row(r, "res", [0.1, 0.9], ["error_10th", "error_90th"])


@register("residual_sketch")
def q_residual_sketch(spark, base):
    """Residual percentiles from a KLL sketch per year, stored and merged: rows
    behind the sketches and whether the estimate's true rank is within the stated
    error (the true rank is counted over all residuals)."""
    _, te = Run(spark, base).key_mean
    r = te.select("Year", (F.col("Yield_Per_Acre").cast("double") - F.col(EV.PRED)).alias("res"))
    est = sketch_quantiles(write_sketches(r, "res", shared_path(spark, "residual_sketches")), [0.1, 0.5, 0.9]).collect()
    ranks = r.agg(F.count("*").alias("n"), *[F.count_if(F.col("res") <= e["value"]).alias(f"le{i}") for i, e in enumerate(est)],
                  *[F.count_if(F.col("res") < e["value"]).alias(f"lt{i}") for i, e in enumerate(est)])
    rows = []
    for i, e in enumerate(est):
        p, slack = F.lit(e["p"]), F.lit(RANK_ERROR)
        ok = (F.col(f"lt{i}") / F.col("n") <= p + slack) & (F.col(f"le{i}") / F.col("n") >= p - slack)
        rows.append(F.struct(p.alias("p"), F.lit(e["n"]).cast("bigint").alias("n"), ok.alias("within_error")))
    return ranks.select(F.inline(F.array(*rows))) if rows else spark.createDataFrame([], "p double, n bigint, within_error boolean")


def banded_test_predictions(spark, base):
    """Saved once as the predictions table; the reports read it back."""
    r = Run(spark, base)
    return _saved(spark, EV.add_bands(r.key_mean[1], r.bands), "predictions")


@register("prediction_bands")
def q_prediction_bands(spark, base):
    return banded_test_predictions(spark, base).select(
        *G.GOLD_KEYS, EV.PRED, "Lower_Bound", "Upper_Bound", "Residual")


@register("predictions_report")
def q_predictions_report(spark, base):
    return EV.predictions_report(banded_test_predictions(spark, base))


@register("yearly_actual_vs_pred")
def q_yearly_actual_vs_pred(spark, base):
    return EV.yearly_actual_vs_pred(banded_test_predictions(spark, base))


@register("split_impact")
def q_split_impact(spark, base):
    return EV.split_impact(Run(spark, base).train)


@register("farmer_summary")
def q_farmer_summary(spark, base):
    r = Run(spark, base)
    return EV.grower_summary(EV.split_impact(r.train), r.bands)


# The model's numeric and categorical features.
NUMERIC = ["Year", "5_Year_Avg_Yield", "60d_Total_Precip", "60d_Avg_Temp",
           "90d_Total_Precip", "90d_Avg_Temp", "90d_Days_Above_95F"]
CATEGORICAL = ["County", "State", "Crop"]


@register("feature_zscore")
def q_feature_zscore(spark, base):
    return M.zscore(Run(spark, base).train, NUMERIC, keep=G.GOLD_KEYS)


@register("onehot_encode")
def q_onehot_encode(spark, base):
    s = Run(spark, base).split
    return M.onehot_columns(s.where("split = 'train'"), s.where("split = 'test'"), CATEGORICAL,
                          keep=G.GOLD_KEYS)


@register("onehot_long")
def q_onehot_long(spark, base):
    s = Run(spark, base).split
    return M.onehot_long(s.where("split = 'train'"), s.where("split = 'test'"), CATEGORICAL, keep=G.GOLD_KEYS)


# --------------------------------------------------------------------------
# Scenarios (F3, C13, H1, K13, K14, D5, F4) with the linear stand-in score
# --------------------------------------------------------------------------
@register("scenario_features")
def q_scenario_features(spark, base):
    return Run(spark, base).scenarios().select(
        *SC.KEYS, "Scenario", "Yield_Per_Acre", "5_Year_Avg_Yield", "60d_Total_Precip",
        "60d_Avg_Temp", "90d_Total_Precip", "90d_Avg_Temp", "90d_Days_Above_95F")


@register("scenario_risk")
def q_scenario_risk(spark, base):
    r = Run(spark, base)
    scored = SC.score_scenarios(r.scenarios(), SC.linear_score, r.bands)
    saved = _saved(spark, SC.risk_vs_baseline(scored), "scenario_analysis")
    return saved.orderBy(*SC.KEYS, "Scenario")


@register("scenario_risk_mean")
def q_scenario_risk_mean(spark, base):
    r = Run(spark, base)
    scored = SC.score_scenarios(r.scenarios(dedupe=False), SC.linear_score, r.bands)
    return SC.risk_vs_mean_baseline(materialize(scored, "scored"))


# --------------------------------------------------------------------------
# Random-forest model (K3-K5, K7-K9, K11-K13); rows-only checks
# --------------------------------------------------------------------------

# The forest of the reference setup: 100 trees, depth 10, seed 42.
RF_PARAMS = {"num_trees": 100, "max_depth": 10, "seed": 42}


def forest_parts(r: Run):
    def build():
        s = materialize(r.split, "split_training")
        tr, te = s.where("split = 'train'"), s.where("split = 'test'")
        return tr, te, M.fit(tr, NUMERIC, CATEGORICAL, EV.TARGET, **RF_PARAMS)
    return r.once("forest", build)


def forest_test_predictions(r: Run):
    def build():
        tr, te, model = forest_parts(r)
        keep = [*G.GOLD_KEYS, *[c for c in NUMERIC if c not in G.GOLD_KEYS]]
        pred = materialize(M.predict(model, te, NUMERIC, EV.TARGET, keep=keep), "rf_test_pred")
        return pred, EV.residual_bands(pred)
    return r.once("forest_pred", build)


@register("rf_predict")
def q_rf_predict(spark, base):
    pred, bands = forest_test_predictions(Run(spark, base))
    return EV.add_bands(pred, bands)


@register("feature_importance")
def q_feature_importance(spark, base):
    _, _, model = forest_parts(Run(spark, base))
    return M.feature_importance(spark, model, NUMERIC, CATEGORICAL)


@register("model_roundtrip")
def q_model_roundtrip(spark, base):
    tr, te, model = forest_parts(Run(spark, base))
    path = M.save_model(model, shared_path(spark, "rf_model"))
    loaded = M.load_model(path)
    return M.predict(loaded, te, NUMERIC, EV.TARGET, keep=G.GOLD_KEYS)


@register("cv_rmse")
def q_cv_rmse(spark, base):
    tr, te, model = forest_parts(Run(spark, base))
    cv = M.cross_validated_rmse(EV.assign_folds(tr), NUMERIC, CATEGORICAL, EV.TARGET, "fold",
                                **RF_PARAMS)
    keep = G.GOLD_KEYS
    both = stack([M.predict(model, tr, NUMERIC, EV.TARGET, keep).withColumn("split", F.lit("train")),
                  M.predict(model, te, NUMERIC, EV.TARGET, keep).withColumn("split", F.lit("test"))])
    mets = {r["split"]: r for r in EV.regression_metrics(both, by=["split"]).collect()}
    metrics = {"cv_mean_rmse": cv, "train_r2": mets["train"]["r2"], "test_r2": mets["test"]["r2"],
               "test_rmse": mets["test"]["rmse"], "test_mae": mets["test"]["mae"]}
    run = unique_name("rf_cv")  # runs accumulate in one table, a partition each
    runs = M.record_metrics(spark, f"{checkpoint_root(spark)}/fieldlens/run_metrics", run, metrics)
    return runs.where(F.col("run_id") == run)


@register("scenario_score")
def q_scenario_score(spark, base):
    r = Run(spark, base)
    _, _, model = forest_parts(r)
    _, bands = forest_test_predictions(r)

    def scorer(df):
        keep = [*SC.KEYS, "Yield_Per_Acre", "Scenario"]
        return M.predict(model, df, NUMERIC, None, keep=keep)

    return SC.risk_vs_baseline(SC.score_scenarios(r.scenarios(), scorer, bands))


@register("forest_checks")
def q_forest_checks(spark, base):
    """What any fitted forest must satisfy, as rows (check_name, detail,
    value): rows scored per state, county and crop; both bands' distance from the
    prediction to the residual percentiles; names in the importance table and
    their sum; the largest difference after saving and loading; rows per fold;
    mismatches between the saved risk and the one recomputed from the
    predictions; rows per fold of a cross-validation's saved predictions, the
    largest difference between its RMSEs and those recomputed from these rows, and
    how many of its recorded metrics read back as recorded.  Every value is computed from the model's own outputs."""
    r = Run(spark, base)
    tr, te, model = forest_parts(r)
    pred, bands = forest_test_predictions(r)
    banded = _saved(spark, EV.add_bands(pred, bands), "forest_predictions")
    imp = _saved(spark, M.feature_importance(spark, model, NUMERIC, CATEGORICAL), "forest_importance")
    loaded = M.load_model(M.save_model(model, shared_path(spark, "rf_model")))
    again = M.predict(loaded, pred.drop(EV.PRED), NUMERIC, None, keep=[*G.GOLD_KEYS, *[
        c for c in NUMERIC if c not in G.GOLD_KEYS]]).withColumnRenamed(EV.PRED, "again")
    keys = [c for c in again.columns if c != "again"]
    # equal rows have equal predictions: compare the sorted pair per distinct row
    both = pred.groupBy(*keys).agg(F.max(EV.PRED).alias("a"), F.min(EV.PRED).alias("b")).alias("p").join(
        again.groupBy(*keys).agg(F.max("again").alias("c")).alias("q"),
        [F.col(f"p.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys])

    def scorer(df):
        return M.predict(model, df, NUMERIC, None, keep=[*SC.KEYS, "Yield_Per_Acre", "Scenario"])

    risk = _saved(spark, SC.risk_vs_baseline(SC.score_scenarios(r.scenarios(), scorer, bands)), "forest_scenarios")
    rmses, held = M.cross_validated(EV.assign_folds(tr), NUMERIC, CATEGORICAL, EV.TARGET, "fold",
                                    **{**RF_PARAMS, "num_trees": 20, "max_depth": 5})
    run = unique_name("cv_check")
    want = {f"rmse_{i}": x for i, x in enumerate(rmses)}
    kept = M.record_metrics(spark, f"{checkpoint_root(spark)}/fieldlens/run_metrics", run, want).where(F.col("run_id") == run)
    again_rmse = held.groupBy("fold").agg(F.sqrt(F.avg((F.col(M.LABEL) - F.col(EV.PRED)) ** 2)).alias("v"))
    kept_as = kept.join(again_rmse, kept["name"] == F.concat(F.lit("rmse_"), F.col("fold").cast("string")))
    base_p = risk.where(F.col("Scenario") == SC.BASELINE).select(*SC.KEYS, F.col(EV.PRED).alias("_b"))
    want = (F.col(EV.PRED) - F.col("_b")) / F.col("_b") * 100
    off = F.abs(F.col("Yield_Risk_%") - want) > 1e-9

    def row(name, detail, value):
        return [F.lit(name).alias("check_name"), detail.alias("detail"), value.cast("double").alias("value")]

    width = (F.col("Upper_Bound") - F.col(EV.PRED) - F.lit(bands[1])) + (F.col("Lower_Bound") - F.col(EV.PRED) - F.lit(bands[0]))
    parts = [
        banded.groupBy(*SC.KEYS).agg(F.count("*").alias("n")).select(
            *row("scored_rows", F.concat_ws("/", *SC.KEYS), F.col("n"))),
        banded.agg(F.round(F.max(F.abs(width)), 6).alias("w")).select(*row("band_error", F.lit("max"), F.col("w"))),
        imp.select(*row("importance_name", F.col("Feature"), F.lit(1))),
        imp.agg(F.round(F.sum("Importance"), 6).alias("s")).select(*row("importance_sum", F.lit("all"), F.col("s"))),
        both.agg(F.max(F.greatest(F.abs(F.col("a") - F.col("c")), F.abs(F.col("b") - F.col("c")))).alias("d"))
        .select(*row("reload_difference", F.lit("max"), F.col("d"))),
        EV.assign_folds(tr).groupBy("fold").agg(F.count("*").alias("n")).select(
            *row("fold_rows", F.col("fold").cast("string"), F.col("n"))),
        risk.join(base_p, SC.KEYS, "left").agg(F.count(F.when(off, 1)).alias("n")).select(
            *row("risk_mismatches", F.lit("all"), F.col("n"))),
        risk.agg(F.count("*").alias("n")).select(*row("risk_rows", F.lit("all"), F.col("n"))),
        held.groupBy("fold").agg(F.count("*").alias("n")).select(*row("cv_rows", F.col("fold").cast("string"), F.col("n"))),
        kept_as.agg(F.round(F.max(F.abs(F.col("value") - F.col("v"))), 6).alias("d"), F.count("*").alias("n")).select(
            F.inline(F.array(*[F.struct(*row(name, F.lit("all"), F.col(c))) for name, c in (
                ("cv_rmse_difference", "d"), ("metrics_read_back", "n"))]))),
    ]
    return stack(parts)


# --------------------------------------------------------------------------
# Streaming refresh
# --------------------------------------------------------------------------
@register("stream_refresh")
def q_stream_refresh(spark, base):
    """Three file drops processed by availableNow streams; the refreshed gold
    table must equal the batch gold table.  Drop 1: weather up to 1998 except
    the second half of 1996, yields up to 1997.  Drop 2: the later weather and
    yields.  Drop 3: the withheld 1996 weather, arriving late (it rewrites only
    the 1996 partitions)."""
    from fieldlens.streaming.refresh import GoldRefresher

    r = GoldRefresher(
        spark, shared_path(spark, "stream"),
        lambda y: G.add_trailing_yield(y, tiebreak=TIEBREAK),
        lambda y, w: G.gold_from_labelled(y, w, hot_threshold=HOT, temp_type=TEMP_TYPE),
        YIELD_CSV, WEATHER_NO_CODES)
    y = A.yield_view(spark, base)
    w = A.weather_view(spark, base)
    late = F.col("date").between(F.lit("1996-07-01").cast("date"), F.lit("1996-12-31").cast("date"))
    FS.write_csv(w.where((F.year("date") <= 1998) & ~late), r.landing("weather") + "/drop-1")
    FS.write_csv(y.where(F.col("Year") <= 1997), r.landing("yield") + "/drop-1")
    r.run_once()
    FS.write_csv(w.where(F.year("date") > 1998), r.landing("weather") + "/drop-2")
    FS.write_csv(y.where(F.col("Year") > 1997), r.landing("yield") + "/drop-2")
    r.run_once()
    FS.write_csv(w.where(late), r.landing("weather") + "/drop-3")
    r.run_once()
    return r.gold_table()
