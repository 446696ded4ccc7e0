"""Analog views: crop-yield shaped tables derived from the test tables.

The test data carries no crops or weather, so yields, daily county weather,
long station observations, stations and county polygons are derived from the
TPC-H-ish tables.  Every view is a plain Spark plan over the parquet files, so
its work grows with the data.  Join strategies are left to the planner and AQE's
runtime size checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.sources.tables import read_table


def _nation_region(spark: SparkSession, base: str) -> DataFrame:
    nation = read_table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, base, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def yield_view(spark: SparkSession, base: str) -> DataFrame:
    """yield_v: one yield record per order (County, State, Crop, Year, ...).

    The fact table joins its key dimension (customer) first; the planner and
    AQE pick the strategy from sizes (the static estimate of a join is the
    product of its inputs, so joining the fixed 25-row nation/region
    dimension first would make the dimension side look larger than the fact
    side).  The small dimension is joined last.
    """
    orders = read_table(spark, base, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"
    )
    customer = read_table(spark, base, "customer").select("c_custkey", "c_nationkey")
    geo = _nation_region(spark, base)
    j = orders.join(customer, orders.o_custkey == customer.c_custkey)
    j = j.join(geo, j.c_nationkey == geo.n_nationkey)
    return j.select(
        F.col("o_orderkey").alias("yield_id"),
        F.col("n_name").alias("County"),
        F.col("r_name").alias("State"),
        F.col("o_orderpriority").alias("Crop"),
        F.year("o_orderdate").cast("int").alias("Year"),
        F.col("o_orderdate").cast("date").alias("Harvest_Date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Yield_Per_Acre"),
    )


def weather_view(spark: SparkSession, base: str) -> DataFrame:
    """weather_v: one row per county and day; TAVG null on some days."""
    li = read_table(spark, base, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_tax", "l_quantity", "l_linenumber", "l_extendedprice"
    )
    supplier = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    geo = _nation_region(spark, base)
    j = li.join(supplier, li.l_suppkey == supplier.s_suppkey)
    j = j.join(geo, j.s_nationkey == geo.n_nationkey)
    g = j.groupBy(
        F.col("r_name").alias("state_abbrev"),
        F.col("n_name").alias("county_name"),
        F.col("l_shipdate").cast("date").alias("date"),
    ).agg(
        F.max("l_tax").alias("AWND"),
        F.sum("l_quantity").cast("decimal(18,2)").alias("PRCP"),
        F.when(F.min("l_linenumber") == 1, F.lit(None).cast("double"))
        .otherwise(F.max("l_extendedprice"))
        .alias("TAVG"),
        F.max("l_extendedprice").alias("TMAX"),
        F.min("l_extendedprice").alias("TMIN"),
    )
    return g


def observation_view(spark: SparkSession, base: str) -> DataFrame:
    """obs_v: long station observations {station, date, datatype, value}."""
    ev = read_table(spark, base, "events").select("user_id", "ts", "event_type", "value")
    return ev.select(
        F.col("user_id").cast("string").alias("station"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("datatype"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def _usw_or_usc(segment: Column, key: Column) -> Column:
    prefix = F.when(segment == "AUTOMOBILE", F.lit("GHCND:USW")).otherwise(F.lit("GHCND:USC"))
    return F.concat(prefix, key.cast("string"))


def station_view(spark: SparkSession, base: str) -> DataFrame:
    """station_v: station metadata; longitude null on every 50th station."""
    c = read_table(spark, base, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        _usw_or_usc(F.col("c_mktsegment"), k).alias("id"),
        F.when(k % 50 == 0, F.lit(None).cast("double"))
        .otherwise(((k * 7919) % 3600).cast("double") / 10 - 180)
        .alias("longitude"),
        (((k * 104729) % 1800).cast("double") / 10 - 90).alias("latitude"),
        F.col("c_acctbal").alias("datacoverage"),
    )


# The four edges of the diamond drawn for every county, as
# (ax, ay, bx, by) offsets from the county's corner (x0, y0).
DIAMOND_EDGES = [(36, 0, 72, 18), (72, 18, 36, 36), (36, 36, 0, 18), (0, 18, 36, 0)]


def county_edge_view(spark: SparkSession, base: str) -> DataFrame:
    """county_edge_v: polygon edges (geoid, x1, y1, x2, y2), 4 per county.

    The corner of each county comes from its nation key; the four edges are a
    per-row generator (``inline`` over a literal array), not a join.
    """
    n = read_table(spark, base, "nation").select("n_nationkey", "n_name")
    x0 = (F.col("n_nationkey") % 5).cast("double") * 72 - F.lit(179.95)
    y0 = F.floor(F.col("n_nationkey") / F.lit(5.0)).cast("double") * 36 - F.lit(89.95)
    edges = F.array(
        *[
            F.struct(
                F.lit(float(ax)).alias("ax"),
                F.lit(float(ay)).alias("ay"),
                F.lit(float(bx)).alias("bx"),
                F.lit(float(by)).alias("by"),
            )
            for ax, ay, bx, by in DIAMOND_EDGES
        ]
    )
    e = n.select(F.col("n_name").alias("geoid"), x0.alias("x0"), y0.alias("y0"), F.inline(edges))
    return e.select(
        "geoid",
        (F.col("x0") + F.col("ax")).alias("x1"),
        (F.col("y0") + F.col("ay")).alias("y1"),
        (F.col("x0") + F.col("bx")).alias("x2"),
        (F.col("y0") + F.col("by")).alias("y2"),
    )


def county_view(spark: SparkSession, base: str) -> DataFrame:
    """County attributes keyed by geoid: names and zero-padded FIPS codes."""
    nation = read_table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, base, "region").select("r_regionkey", "r_name")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return j.select(
        F.col("n_name").alias("geoid"),
        F.col("r_name").alias("state_abbrev"),
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("state_fips"),
        F.col("n_name").alias("county_name"),
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("county_fips"),
    )
