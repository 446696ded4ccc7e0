"""M5: station records -> one wide row per county and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.exprs import prefix_flag
from fieldlens.operators.aggregates import pivot_mean
from fieldlens.operators.joins import left_join_dim
from fieldlens.operators.spatial import points_in_polygons
from fieldlens.operators.windows import first_per_key

# The station id prefix of first-order (airport / climate)
# stations, and the daily datatypes requested per station, in request order.
PRIMARY_PREFIX = "GHCND:USW"
DATATYPES = ["TMAX", "TMIN", "TAVG", "PRCP", "EVAP", "TSUN", "AWND"]

COUNTY_KEYS = ["state_abbrev", "state_fips", "county_name", "county_fips"]


def stations_in_counties(stations: DataFrame, edges: DataFrame, *, cell: float) -> DataFrame:
    """D3 with the station attributes carried: (geoid, id, datacoverage)."""
    return points_in_polygons(stations, edges, cell=cell, carry=["datacoverage"])


def best_station_per_county(located: DataFrame) -> DataFrame:
    """F2 + C10: per county keep the primary-network station first, then the
    highest data coverage (nulls last), then the smallest id."""
    s = located.withColumn("is_usw", prefix_flag("id", PRIMARY_PREFIX))
    order = [("is_usw", "desc"), ("datacoverage", "desc", True), ("id", "asc")]
    return first_per_key(s, ["geoid"], order).select("geoid", "id", "is_usw", "datacoverage")


def county_day_weather(
    observations: DataFrame,
    best: DataFrame,
    counties: DataFrame,
    *,
    station_key: str,
    datatypes: Sequence[str] = DATATYPES,
    drop_unseen: bool = False,
) -> DataFrame:
    """D2 + E1 + E2: observations left-joined to the chosen station of each
    county, records of unassigned stations dropped (as a group-by over a null
    key drops them), then the mean per county, day and datatype, pivoted to
    one column per asked datatype, so that the schema does not depend on the
    data.  ``drop_unseen`` leaves out datatypes that no record has."""
    dim = best.join(counties, "geoid").select(F.col(station_key).alias("_sk"), *COUNTY_KEYS)
    j = left_join_dim(observations, dim, left_on="station", right_on="_sk",
                      dim_cols=COUNTY_KEYS)
    return pivot_mean(j, [*COUNTY_KEYS, "date"], "datatype", list(datatypes), "value",
                      drop_unseen=drop_unseen)
