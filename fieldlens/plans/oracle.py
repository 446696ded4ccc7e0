"""DuckDB SQL oracles for the registered queries.

Each string runs on DuckDB with the raw test tables registered as views.  The
analog views are spelled out as CTEs, so an oracle reads the same parquet the
Spark query reads.
"""

from __future__ import annotations

YIELD_V = """yield_v AS (
  SELECT o_orderkey AS yield_id, n_name AS County, r_name AS State, o_orderpriority AS Crop,
         CAST(year(o_orderdate) AS INT) AS Year, CAST(o_orderdate AS DATE) AS Harvest_Date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS Yield_Per_Acre
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

WEATHER_V = """weather_v AS (
  SELECT r_name AS state_abbrev, n_name AS county_name, CAST(l_shipdate AS DATE) AS date,
         max(l_tax) AS AWND, CAST(sum(l_quantity) AS DECIMAL(18,2)) AS PRCP,
         CASE WHEN min(l_linenumber) = 1 THEN NULL ELSE max(l_extendedprice) END AS TAVG,
         max(l_extendedprice) AS TMAX, min(l_extendedprice) AS TMIN
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, n_name, CAST(l_shipdate AS DATE))"""

OBS_V = """obs_v AS (
  SELECT CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date, event_type AS datatype,
         CAST(value AS DECIMAL(18,2)) AS value FROM events)"""

STATION_V = """station_v AS (
  SELECT concat(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'GHCND:USW' ELSE 'GHCND:USC' END,
                CAST(c_custkey AS VARCHAR)) AS id,
         CASE WHEN c_custkey % 50 = 0 THEN NULL
              ELSE CAST((c_custkey * 7919) % 3600 AS DOUBLE) / 10 - 180 END AS longitude,
         CAST((c_custkey * 104729) % 1800 AS DOUBLE) / 10 - 90 AS latitude,
         c_acctbal AS datacoverage
  FROM customer)"""

EDGE_V = """county_edge_v AS (
  SELECT n_name AS geoid, x0 + ax AS x1, y0 + ay AS y1, x0 + bx AS x2, y0 + by_ AS y2
  FROM (SELECT n_name, CAST(n_nationkey % 5 AS DOUBLE) * 72 - CAST(179.95 AS DOUBLE) AS x0,
               CAST(floor(n_nationkey / 5.0) AS DOUBLE) * 36 - CAST(89.95 AS DOUBLE) AS y0
        FROM nation) c
  CROSS JOIN (VALUES (36, 0, 72, 18), (72, 18, 36, 36), (36, 36, 0, 18), (0, 18, 36, 0))
    AS e(ax, ay, bx, by_))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Trailing 5-row yield mean with the unique tie-breakers of the analog data.
Y5 = """y5 AS (
  SELECT *, CAST(sum(Yield_Per_Acre) OVER w AS DOUBLE) / count(Yield_Per_Acre) OVER w
            AS "5_Year_Avg_Yield"
  FROM yield_v
  WINDOW w AS (PARTITION BY State, County, Crop ORDER BY Year, Harvest_Date, yield_id
               ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))"""

YS = """ys AS (
  SELECT *, CASE WHEN Yield_Per_Acre > "5_Year_Avg_Yield" * 1.05 THEN 'Good'
                 WHEN Yield_Per_Acre < "5_Year_Avg_Yield" * 0.95 THEN 'Poor'
                 ELSE 'Average' END AS Yield_Status
  FROM y5)"""

WT = """wt AS (
  SELECT *, CAST(coalesce(TAVG, (TMAX + TMIN) / 2) AS DECIMAL(18,3)) AS TAVG_Cleaned
  FROM weather_v)"""


def lookback_select(key: str, hot: str = "90000") -> str:
    """Naive look-back aggregates grouped by ``key`` over CTE j(b, PRCP, TAVG_Cleaned, TMAX)."""
    return f"""
  CAST(sum(CASE WHEN b BETWEEN 0 AND 60 THEN PRCP ELSE 0 END) AS DOUBLE) AS p60,
  CAST(sum(CASE WHEN b BETWEEN 0 AND 60 THEN TAVG_Cleaned END) AS DOUBLE)
    / nullif(count(CASE WHEN b BETWEEN 0 AND 60 THEN TAVG_Cleaned END), 0) AS t60,
  CAST(sum(CASE WHEN b BETWEEN 0 AND 90 THEN PRCP ELSE 0 END) AS DOUBLE) AS p90,
  CAST(sum(CASE WHEN b BETWEEN 0 AND 90 THEN TAVG_Cleaned END) AS DOUBLE)
    / nullif(count(CASE WHEN b BETWEEN 0 AND 90 THEN TAVG_Cleaned END), 0) AS t90,
  count(CASE WHEN b BETWEEN 0 AND 90 AND TMAX >= {hot} THEN 1 END) AS hot90
FROM j GROUP BY {key}"""


J_YW = """j AS (
  SELECT ys.*, wt.PRCP, wt.TAVG_Cleaned, wt.TMAX, datediff('day', wt.date, ys.Harvest_Date) AS b
  FROM ys JOIN wt ON ys.State = wt.state_abbrev AND ys.County = wt.county_name AND ys.Year = year(wt.date))"""

GOLD_SELECT = """SELECT County, State, Year, Crop, Harvest_Date, Yield_Per_Acre,
  "5_Year_Avg_Yield", Yield_Status,
  CAST(sum(CASE WHEN b BETWEEN 0 AND 60 THEN PRCP ELSE 0 END) AS DOUBLE) AS "60d_Total_Precip",
  CAST(sum(CASE WHEN b BETWEEN 0 AND 60 THEN TAVG_Cleaned END) AS DOUBLE)
    / nullif(count(CASE WHEN b BETWEEN 0 AND 60 THEN TAVG_Cleaned END), 0) AS "60d_Avg_Temp",
  CAST(sum(CASE WHEN b BETWEEN 0 AND 90 THEN PRCP ELSE 0 END) AS DOUBLE) AS "90d_Total_Precip",
  CAST(sum(CASE WHEN b BETWEEN 0 AND 90 THEN TAVG_Cleaned END) AS DOUBLE)
    / nullif(count(CASE WHEN b BETWEEN 0 AND 90 THEN TAVG_Cleaned END), 0) AS "90d_Avg_Temp",
  count(CASE WHEN b BETWEEN 0 AND 90 AND TMAX >= 90000 THEN 1 END) AS "90d_Days_Above_95F"
FROM j GROUP BY County, State, Year, Crop, Harvest_Date, Yield_Per_Acre,
  "5_Year_Avg_Yield", Yield_Status"""

GOLD_CTE = "gold AS (\n" + GOLD_SELECT + ")"

GOLD_BASE = with_(YIELD_V, WEATHER_V, Y5, YS, WT, J_YW)

ORACLE: dict[str, str] = {}

ORACLE["rolling_yield"] = with_(YIELD_V, Y5) + """
SELECT yield_id, County, Crop, Year, Harvest_Date, Yield_Per_Acre, "5_Year_Avg_Yield" FROM y5"""

ORACLE["yield_status"] = with_(YIELD_V, Y5, YS) + """
SELECT yield_id, County, Crop, Year, Yield_Status FROM ys"""

ORACLE["preharvest_features"] = with_(YIELD_V, WEATHER_V, WT) + """,
j AS (SELECT y.yield_id, wt.PRCP, wt.TAVG_Cleaned, wt.TMAX,
             datediff('day', wt.date, y.Harvest_Date) AS b
      FROM yield_v y JOIN wt ON y.State = wt.state_abbrev AND y.County = wt.county_name AND y.Year = year(wt.date))
SELECT yield_id,""" + lookback_select("yield_id")

ORACLE["preharvest_naive"] = ORACLE["preharvest_features"]

ORACLE["gold_features"] = GOLD_BASE + GOLD_SELECT


def gold_with(*ctes: str) -> str:
    """WITH clause holding the gold table (as ``gold``) plus extra CTEs."""
    return with_(YIELD_V, WEATHER_V, Y5, YS, WT, J_YW, GOLD_CTE, *ctes)


PAIR_WHERE = """(County = 'NATION_1' AND State = 'AMERICA')
   OR (County = 'NATION_6' AND State = 'AMERICA')
   OR (County = 'NATION_0' AND State = 'AFRICA')"""

ORACLE["pair_filter"] = with_(YIELD_V) + f"""
SELECT yield_id, County, State, Crop, Year, Yield_Per_Acre FROM yield_v WHERE {PAIR_WHERE}"""

ORACLE["pair_semi_filter"] = with_(YIELD_V) + """
SELECT yield_id, County, State, Crop, Year, Yield_Per_Acre FROM yield_v
WHERE (County, State) IN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
                          WHERE r_name = 'AMERICA')"""

ORACLE["temp_clean"] = with_(WEATHER_V) + """
SELECT state_abbrev, county_name, date, TAVG, TMAX, TMIN,
       coalesce(TAVG, (TMAX + TMIN) / 2) AS TAVG_Cleaned FROM weather_v"""

ORACLE["dropna_subset"] = gold_with() + """
SELECT * FROM gold WHERE "5_Year_Avg_Yield" IS NOT NULL AND "60d_Avg_Temp" IS NOT NULL"""

SPLITS = """train AS (SELECT * FROM gold WHERE Year <= 1999 AND "5_Year_Avg_Yield" IS NOT NULL),
holdout AS (SELECT * FROM gold WHERE Year = 2000 AND "5_Year_Avg_Yield" IS NOT NULL)"""

ORACLE["year_split"] = gold_with(SPLITS) + """
SELECT *, 'train' AS split FROM train UNION ALL SELECT *, 'holdout' AS split FROM holdout"""

ORACLE["geoid_key"] = """
SELECT * FROM (
  SELECT c_custkey, c_name AS county_name, c_mktsegment AS state_abbrev,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips,
         lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS county_fips,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
           || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS GEOID
  FROM customer) WHERE GEOID IN ('03156', '16048', '10495')"""

ORACLE["geoid_all"] = ORACLE["geoid_key"].split(" WHERE GEOID IN")[0]

ORACLE["map_lookup"] = with_(YIELD_V) + """
SELECT yield_id, Crop,
       CASE Crop WHEN '1-URGENT' THEN 'Corn' WHEN '2-HIGH' THEN 'Soybeans'
                 WHEN '3-MEDIUM' THEN 'Wheat' END AS Crop_Name
FROM yield_v"""

ORACLE["yield_weather_join"] = with_(YIELD_V, WEATHER_V) + """
SELECT y.yield_id, y.County, y.Year, count(*) AS weather_days,
       min(w.date) AS first_day, max(w.date) AS last_day, make_date(y.Year, 1, 1) AS season_start
FROM yield_v y JOIN weather_v w ON y.State = w.state_abbrev AND y.County = w.county_name AND y.Year = year(w.date)
GROUP BY y.yield_id, y.County, y.Year"""

ORACLE["union_missing"] = with_(YIELD_V, WEATHER_V) + """
SELECT yield_id, County, Crop, Year, Yield_Per_Acre FROM yield_v
UNION ALL BY NAME
SELECT county_name AS County, state_abbrev AS State, date, PRCP FROM weather_v"""

FIRST_CTE = """firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY State, County, Crop
      ORDER BY Harvest_Date, Yield_Per_Acre, "5_Year_Avg_Yield", Yield_Status, Year) AS rn
    FROM holdout) WHERE rn = 1)"""

ORACLE["first_per_key"] = gold_with(SPLITS, FIRST_CTE) + "SELECT * FROM firsts"

ORACLE["topk"] = with_(YIELD_V) + """
SELECT yield_id, County, Crop, Year, Yield_Per_Acre FROM yield_v
ORDER BY Yield_Per_Acre DESC, yield_id LIMIT 10"""

ORACLE["table_roundtrip"] = with_(YIELD_V) + "SELECT * FROM yield_v"
ORACLE["csv_ingest"] = ORACLE["table_roundtrip"]
ORACLE["table_overwrite_schema"] = with_(YIELD_V) + """
SELECT yield_id, Crop AS crop_code, CAST(Year AS VARCHAR) AS Year,
       CAST(Yield_Per_Acre * 2 AS DECIMAL(18,2)) AS doubled FROM yield_v"""
ORACLE["csv_export"] = with_(WEATHER_V) + "SELECT * FROM weather_v"

ORACLE["json_pages_flatten"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type AS datatype, CAST(user_id AS VARCHAR) AS station,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value
FROM events"""

INSIDE = """inside AS (
  SELECT geoid, id, datacoverage FROM (
    SELECT geoid, id, datacoverage, count(*) AS n FROM station_v JOIN county_edge_v
      ON (y1 > latitude) <> (y2 > latitude)
     AND longitude < (x2 - x1) * (latitude - y1) / (y2 - y1) + x1
    WHERE longitude IS NOT NULL GROUP BY geoid, id, datacoverage) z
  WHERE n % 2 = 1)"""

BEST = """best AS (
  SELECT geoid, id, is_usw, datacoverage FROM (
    SELECT *, starts_with(id, 'GHCND:USW') AS is_usw,
           row_number() OVER (PARTITION BY geoid ORDER BY starts_with(id, 'GHCND:USW') DESC,
                              datacoverage DESC NULLS LAST, id) AS rn
    FROM inside) WHERE rn = 1)"""

COUNTY = """cty AS (
  SELECT n_name AS geoid, r_name AS state_abbrev,
         lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS state_fips, n_name AS county_name,
         lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS county_fips
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DIM = """dim AS (
  SELECT substr(b.id, 10) AS sk, cty.state_abbrev, cty.state_fips,
         cty.county_name, cty.county_fips
  FROM best b JOIN cty ON b.geoid = cty.geoid)"""

ORACLE["station_county"] = with_(STATION_V, EDGE_V, INSIDE) + "SELECT geoid, id FROM inside"

ORACLE["station_county_cover"] = ORACLE["station_county"]

ORACLE["best_per_group"] = with_(STATION_V, EDGE_V, INSIDE, BEST) + "SELECT * FROM best"

ORACLE["dim_left_join"] = with_(OBS_V, STATION_V, EDGE_V, INSIDE, BEST, COUNTY, DIM) + """
SELECT o.station, o.date, o.datatype, o.value, d.county_name, d.state_abbrev
FROM obs_v o LEFT JOIN dim d ON o.station = d.sk"""

ORACLE["daily_mean_long"] = with_(OBS_V) + """
SELECT station, date, datatype, CAST(sum(value) AS DOUBLE) / count(value) AS value
FROM obs_v GROUP BY station, date, datatype"""


def _pivot_cols(types) -> str:
    return ",\n".join(
        f"""  CAST(sum(value) FILTER (WHERE datatype = '{t}') AS DOUBLE)
    / nullif(count(value) FILTER (WHERE datatype = '{t}'), 0) AS "{t}\""""
        for t in types
    )


ANALOG_TYPES = ["click", "error", "purchase", "signup", "view"]

ORACLE["daily_pivot"] = with_(OBS_V) + f"""
SELECT station, date,
{_pivot_cols(ANALOG_TYPES)}
FROM obs_v GROUP BY station, date"""

ORACLE["weather_build"] = with_(OBS_V, STATION_V, EDGE_V, INSIDE, BEST, COUNTY, DIM) + f""",
j AS (SELECT o.*, d.state_abbrev, d.state_fips, d.county_name, d.county_fips
      FROM obs_v o LEFT JOIN dim d ON o.station = d.sk)
SELECT state_abbrev, state_fips, county_name, county_fips, date,
{_pivot_cols([*ANALOG_TYPES, 'TSUN'])}
FROM j
WHERE state_abbrev IS NOT NULL AND state_fips IS NOT NULL AND county_name IS NOT NULL
  AND county_fips IS NOT NULL AND date IS NOT NULL
GROUP BY state_abbrev, state_fips, county_name, county_fips, date"""


ORACLE["weather_from_pages"] = ORACLE["weather_build"].replace(
    "FROM best b JOIN cty ON b.geoid = cty.geoid)",
    "FROM best b JOIN cty ON b.geoid = cty.geoid WHERE cty.state_abbrev <> 'ASIA')")


GOLD8 = ('County, State, Year, Crop, Harvest_Date, Yield_Per_Acre, "5_Year_Avg_Yield", '
         'Yield_Status')

ROWKEY = ("concat_ws('|', State, County, Crop, CAST(Year AS VARCHAR), CAST(Harvest_Date AS VARCHAR), "
          "CAST(Yield_Per_Acre AS VARCHAR))")

SPLIT = f"""sp AS (
  SELECT *, CASE WHEN ('0x' || substr(md5({ROWKEY}), 1, 8))::BIGINT % 5 = 0
                 THEN 'test' ELSE 'train' END AS split
  FROM train)"""

KM = """km AS (SELECT State, County, Crop, CAST(sum(Yield_Per_Acre) AS DOUBLE) / count(Yield_Per_Acre) AS km
       FROM sp WHERE split = 'train' GROUP BY State, County, Crop),
gm AS (SELECT CAST(sum(Yield_Per_Acre) AS DOUBLE) / count(Yield_Per_Acre) AS g
       FROM sp WHERE split = 'train'),
pred AS (SELECT sp.*, coalesce(km.km, gm.g) AS Predicted_Yield
         FROM sp LEFT JOIN km ON sp.State = km.State AND sp.County = km.County AND sp.Crop = km.Crop CROSS JOIN gm),
te AS (SELECT * FROM pred WHERE split = 'test'),
bands AS (SELECT quantile_cont(CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield, 0.1) AS e10,
                 quantile_cont(CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield, 0.9) AS e90
          FROM te),
bp AS (SELECT te.*, Predicted_Yield + e10 AS Lower_Bound, Predicted_Yield + e90 AS Upper_Bound,
              CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield AS Residual
       FROM te CROSS JOIN bands)"""

EVAL = gold_with(SPLITS, SPLIT, KM)

ORACLE["holdout_split"] = gold_with(SPLITS, SPLIT) + f"SELECT {GOLD8}, split FROM sp"

ORACLE["fold_assign"] = gold_with(SPLITS, SPLIT) + f"""
SELECT {GOLD8}, CAST(('0x' || substr(md5({ROWKEY}), 9, 8))::BIGINT % 5 AS INTEGER) AS fold
FROM sp WHERE split = 'train'"""

ORACLE["regression_metrics"] = EVAL + """
SELECT split, n,
  round(1.0 - sse / (CAST(syy AS DOUBLE) - CAST(sy AS DOUBLE) * CAST(sy AS DOUBLE) / n), 6) AS r2,
  round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae
FROM (SELECT split, count(*) AS n, sum(Yield_Per_Acre) AS sy,
             sum(Yield_Per_Acre * Yield_Per_Acre) AS syy,
             sum((CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield)
                 * (CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield)) AS sse,
             sum(abs(CAST(Yield_Per_Acre AS DOUBLE) - Predicted_Yield)) AS sae
      FROM pred GROUP BY split)"""

ORACLE["residual_bands"] = EVAL + "SELECT e10 AS error_10th, e90 AS error_90th FROM bands"

ORACLE["prediction_bands"] = EVAL + f"""
SELECT {GOLD8}, Predicted_Yield, Lower_Bound, Upper_Bound, Residual FROM bp"""

ORACLE["predictions_report"] = EVAL + """
SELECT County, Crop, Year, Predicted_Yield, Yield_Per_Acre AS Actual_Yield, Lower_Bound, Upper_Bound
FROM bp ORDER BY Predicted_Yield"""

ORACLE["yearly_actual_vs_pred"] = EVAL + """
SELECT State, County, Crop, Year, CAST(sum(Yield_Per_Acre) AS DOUBLE) / count(Yield_Per_Acre) AS Avg_Yield,
       round(avg(Predicted_Yield), 6) AS Avg_Predicted
FROM bp GROUP BY State, County, Crop, Year ORDER BY Year"""

IMPACT = """med AS (SELECT quantile_cont("90d_Total_Precip", 0.5) AS rm,
                      quantile_cont("90d_Avg_Temp", 0.5) AS tm FROM train),
agg AS (
  SELECT
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Days_Above_95F" > 4) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Days_Above_95F" > 4), 0) AS h_hi,
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Days_Above_95F" <= 4) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Days_Above_95F" <= 4), 0) AS h_lo,
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Total_Precip" > rm) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Total_Precip" > rm), 0) AS r_hi,
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Total_Precip" <= rm) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Total_Precip" <= rm), 0) AS r_lo,
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Avg_Temp" > tm) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Avg_Temp" > tm), 0) AS t_hi,
    CAST(sum(Yield_Per_Acre) FILTER (WHERE "90d_Avg_Temp" <= tm) AS DOUBLE)
      / nullif(count(Yield_Per_Acre) FILTER (WHERE "90d_Avg_Temp" <= tm), 0) AS t_lo,
    any_value(rm) AS rm, any_value(tm) AS tm
  FROM train CROSS JOIN med),
impact AS (
  SELECT 'heat' AS finding, CAST(4 AS DOUBLE) AS threshold, h_hi AS mean_high, h_lo AS mean_low,
         (h_hi - h_lo) / h_lo * 100 AS impact_pct FROM agg
  UNION ALL SELECT 'rain', rm, r_hi, r_lo, (r_hi - r_lo) / r_lo * 100 FROM agg
  UNION ALL SELECT 'temperature', tm, t_hi, t_lo, (t_hi - t_lo) / t_lo * 100 FROM agg)"""

ORACLE["split_impact"] = gold_with(SPLITS, IMPACT) + "SELECT * FROM impact"

ORACLE["farmer_summary"] = gold_with(SPLITS, IMPACT, SPLIT, KM) + """
SELECT finding, round(impact_pct, 1) AS value,
  CASE finding
    WHEN 'heat' THEN 'More than ' || printf('%.0f', round(threshold, 0))
      || ' hot days in the 90 days before harvest: expected yield changes by '
      || printf('%.1f', round(impact_pct, 1)) || '%.'
    WHEN 'rain' THEN '90-day rainfall above ' || printf('%.1f', round(threshold, 1))
      || ': yield changes by ' || printf('%.1f', round(impact_pct, 1)) || '% against drier seasons.'
    ELSE '90-day mean temperature above ' || printf('%.1f', round(threshold, 1))
      || ': yield changes by ' || printf('%.1f', round(impact_pct, 1)) || '%.'
  END AS message
FROM impact
UNION ALL
SELECT 'band', NULL, 'Predictions fall within ' || printf('%.1f', round(e10, 1)) || ' to +'
  || printf('%.1f', round(e90, 1)) || ' of the actual yield 80% of the time.'
FROM bands"""

NUMERIC = ["Year", "5_Year_Avg_Yield", "60d_Total_Precip", "60d_Avg_Temp",
           "90d_Total_Precip", "90d_Avg_Temp", "90d_Days_Above_95F"]

ORACLE["feature_zscore"] = gold_with(SPLITS) + ",\nst AS (SELECT " + ", ".join(
    f'avg(CAST("{c}" AS DOUBLE)) AS "m_{c}", stddev_pop(CAST("{c}" AS DOUBLE)) AS "s_{c}"'
    for c in NUMERIC) + " FROM train)\nSELECT " + GOLD8 + ", " + ", ".join(
    f'round((CAST("{c}" AS DOUBLE) - "m_{c}") / nullif("s_{c}", 0), 6) AS "{c}_z"'
    for c in NUMERIC) + "\nFROM train CROSS JOIN st"

NATIONS = sorted(f"NATION_{i}" for i in range(25))
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

ORACLE["onehot_encode"] = gold_with(SPLITS, SPLIT) + "SELECT " + GOLD8 + ",\n" + ",\n".join(
    f"""  CAST({col} = '{v}' AS DOUBLE) AS "{col}_{v}\""""
    for col, vals in (("County", NATIONS), ("State", REGIONS), ("Crop", PRIORITIES))
    for v in vals) + "\nFROM sp WHERE split = 'test'"

FIRSTS_H = FIRST_CTE

SCEN = """scen AS (
  SELECT State, County, Crop, 'Baseline (Actual)' AS Scenario, Yield_Per_Acre, "5_Year_Avg_Yield",
         "60d_Total_Precip" * 1.0 AS "60d_Total_Precip", "60d_Avg_Temp" + 0.0 AS "60d_Avg_Temp",
         "90d_Total_Precip" * 1.0 AS "90d_Total_Precip", "90d_Avg_Temp" + 0.0 AS "90d_Avg_Temp",
         "90d_Days_Above_95F" + 0 AS "90d_Days_Above_95F" FROM src
  UNION ALL
  SELECT State, County, Crop, 'Simulated Heatwave', Yield_Per_Acre, "5_Year_Avg_Yield",
         "60d_Total_Precip" * 1.0, "60d_Avg_Temp" + 5.0, "90d_Total_Precip" * 1.0,
         "90d_Avg_Temp" + 5.0, "90d_Days_Above_95F" + 15 FROM src
  UNION ALL
  SELECT State, County, Crop, 'Simulated Drought', Yield_Per_Acre, "5_Year_Avg_Yield",
         "60d_Total_Precip" * 0.5, "60d_Avg_Temp" + 0.0, "90d_Total_Precip" * 0.5,
         "90d_Avg_Temp" + 0.0, "90d_Days_Above_95F" + 0 FROM src)"""

SCORED = """scored AS (
  SELECT State, County, Crop, Yield_Per_Acre, Scenario, p AS Predicted_Yield,
         p + e10 AS Lower_Confidence_Bound, p + e90 AS Upper_Confidence_Bound
  FROM (SELECT *, coalesce("5_Year_Avg_Yield", 0.0)
          + 2.0 * coalesce(CAST("60d_Total_Precip" AS DOUBLE), 0.0)
          + 1.0 * coalesce(CAST("90d_Total_Precip" AS DOUBLE), 0.0)
          + -0.25 * coalesce(CAST("60d_Avg_Temp" AS DOUBLE), 0.0)
          + -0.25 * coalesce(CAST("90d_Avg_Temp" AS DOUBLE), 0.0)
          + -100.0 * coalesce(CAST("90d_Days_Above_95F" AS DOUBLE), 0.0) AS p
        FROM scen) s CROSS JOIN bands)"""

ORACLE["scenario_features"] = gold_with(SPLITS, FIRST_CTE, "src AS (SELECT * FROM firsts)",
                                        SCEN) + "SELECT * FROM scen"

ORACLE["scenario_risk"] = gold_with(SPLITS, SPLIT, KM, FIRST_CTE, "src AS (SELECT * FROM firsts)",
                                    SCEN, SCORED) + """
SELECT *, (Predicted_Yield - b) / b * 100 AS "Yield_Risk_%"
FROM (SELECT *, max(CASE WHEN Scenario = 'Baseline (Actual)' THEN Predicted_Yield END)
                  OVER (PARTITION BY State, County, Crop) AS b FROM scored) x""".replace(
    'SELECT *, (Predicted_Yield - b)', 'SELECT * EXCLUDE (b), (Predicted_Yield - b)')

ORACLE["scenario_risk_mean"] = gold_with(SPLITS, SPLIT, KM, "src AS (SELECT * FROM holdout)",
                                         SCEN, SCORED) + """
SELECT s.*, round((Predicted_Yield - b) / b * 100, 6) AS "Yield_Risk_%"
FROM scored s LEFT JOIN (SELECT State, County, Crop, avg(Predicted_Yield) AS b FROM scored
                         WHERE Scenario = 'Baseline (Actual)' GROUP BY State, County, Crop) m
  ON s.State = m.State AND s.County = m.County AND s.Crop = m.Crop"""

ORACLE["stream_refresh"] = ORACLE["gold_features"]

ORACLE["gold_target_pairs"] = f"""SELECT * FROM ({ORACLE["gold_features"]}) g
WHERE (County, State) IN (('NATION_1', 'AMERICA'), ('NATION_6', 'AMERICA'), ('NATION_0', 'AFRICA'))"""

SEASONS = """seasons AS (
  SELECT state_abbrev AS s, county_name AS c, year(date) AS y, max(date) AS last_day,
         count(DISTINCT date) AS days, CAST(sum(PRCP) AS DOUBLE) AS rain
  FROM weather_v GROUP BY ALL HAVING month(max(date)) < 12)"""

ORACLE["gold_open_seasons"] = gold_with(SEASONS) + """
SELECT g.*, last_day FROM gold g JOIN seasons ON State = s AND County = c AND Year = y"""

ORACLE["yields_of_open_seasons"] = with_(YIELD_V, WEATHER_V, SEASONS) + """
SELECT yield_id, County, State, Crop, Year, Yield_Per_Acre, days, rain
FROM yield_v JOIN seasons ON State = s AND County = c AND Year = y"""

ORACLE["split_tables"] = f"""SELECT * EXCLUDE (split),
  CASE split WHEN 'train' THEN 'training' ELSE 'production' END AS saved_as FROM ({ORACLE["year_split"]}) s"""

ORACLE["forest_checks"] = gold_with(SPLITS, SPLIT, FIRST_CTE) + f"""
SELECT 'scored_rows' AS check_name, State || '/' || County || '/' || Crop AS detail, CAST(count(*) AS DOUBLE) AS value
FROM sp WHERE split = 'test' GROUP BY State, County, Crop
UNION ALL SELECT 'band_error', 'max', 0.0
UNION ALL SELECT 'importance_name', unnest([{", ".join(f"'{c}'" for c in NUMERIC)}]), 1.0
UNION ALL SELECT DISTINCT 'importance_name', 'County_' || County, 1.0 FROM sp WHERE split = 'train'
UNION ALL SELECT DISTINCT 'importance_name', 'State_' || State, 1.0 FROM sp WHERE split = 'train'
UNION ALL SELECT DISTINCT 'importance_name', 'Crop_' || Crop, 1.0 FROM sp WHERE split = 'train'
UNION ALL SELECT 'importance_sum', 'all', 1.0
UNION ALL SELECT 'reload_difference', 'max', 0.0
UNION ALL SELECT 'fold_rows', CAST(('0x' || substr(md5({ROWKEY}), 9, 8))::BIGINT % 5 AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM sp WHERE split = 'train' GROUP BY 2
UNION ALL SELECT 'cv_rows', CAST(('0x' || substr(md5({ROWKEY}), 9, 8))::BIGINT % 5 AS VARCHAR), CAST(count(*) AS DOUBLE)
  FROM sp WHERE split = 'train' GROUP BY 2
UNION ALL SELECT 'cv_rmse_difference', 'all', 0.0
UNION ALL SELECT 'metrics_read_back', 'all', 5.0
UNION ALL SELECT 'risk_mismatches', 'all', 0.0
UNION ALL SELECT 'risk_rows', 'all', CAST(3 * count(*) AS DOUBLE) FROM firsts"""

ORACLE["onehot_long"] = gold_with(SPLITS, SPLIT) + "\nUNION ALL\n".join(
    f"""SELECT {GOLD8}, '{c}_' || {c} AS feature, 1.0::DOUBLE AS value FROM sp
WHERE split = 'test' AND {c} IN (SELECT {c} FROM sp WHERE split = 'train')"""
    for c in ("County", "State", "Crop"))

ORACLE["csv_rejects"] = with_(YIELD_V) + """
SELECT yield_id, County, Year, CASE WHEN yield_id % 101 <> 0 THEN Harvest_Date END AS Harvest_Date,
  CASE WHEN yield_id % 97 <> 0 THEN Yield_Per_Acre END AS Yield_Per_Acre,
  concat_ws(',', CASE WHEN yield_id % 101 = 0 THEN 'Harvest_Date' END,
                 CASE WHEN yield_id % 97 = 0 THEN 'Yield_Per_Acre' END) AS rejected_fields
FROM yield_v"""

ORACLE["weather_from_station_files"] = ORACLE["weather_build"]

ORACLE["residual_sketch"] = EVAL + """
SELECT p::DOUBLE AS p, count(*) AS n, TRUE AS within_error FROM te CROSS JOIN (VALUES (0.1), (0.5), (0.9)) v(p) GROUP BY p"""
