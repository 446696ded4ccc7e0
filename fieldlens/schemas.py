"""Explicit schemas of the tables the pipeline reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw yield CSV (bronze_yield); unknown extra columns are not read.
YIELD_CSV = T.StructType([
    T.StructField("yield_id", T.LongType(), True),
    T.StructField("County", T.StringType(), True),
    T.StructField("State", T.StringType(), True),
    T.StructField("Crop", T.StringType(), True),
    T.StructField("Year", T.IntegerType(), True),
    T.StructField("Harvest_Date", T.DateType(), True),
    T.StructField("Yield_Per_Acre", T.DecimalType(18, 2), True),
])

# County-day weather CSV (bronze_weather_county); FIPS codes stay strings.
WEATHER_CSV = T.StructType([
    T.StructField("state_abbrev", T.StringType(), True),
    T.StructField("state_fips", T.StringType(), True),
    T.StructField("county_name", T.StringType(), True),
    T.StructField("county_fips", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("AWND", T.DoubleType(), True),
    T.StructField("PRCP", T.DecimalType(18, 2), True),
    T.StructField("TAVG", T.DoubleType(), True),
    T.StructField("TMAX", T.DoubleType(), True),
    T.StructField("TMIN", T.DoubleType(), True),
])

# The same without the codes, as the refresh and the analog view carry it.
WEATHER_NO_CODES = T.StructType([f for f in WEATHER_CSV if not f.name.endswith("_fips")])

# One record of a landed observation page.
OBSERVATION_RECORD = T.StructType([
    T.StructField("date", T.StringType(), True),
    T.StructField("datatype", T.StringType(), True),
    T.StructField("station", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])

# One record of a landed station page.
STATION_RECORD = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("datacoverage", T.DoubleType(), True),
])
