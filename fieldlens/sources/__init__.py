"""Scans and sinks: parquet tables, analog views, CSV, landed JSON pages."""

from fieldlens.sources.tables import read_table
from fieldlens.sources.analogs import (
    yield_view,
    weather_view,
    observation_view,
    station_view,
    county_edge_view,
)

__all__ = [
    "read_table",
    "yield_view",
    "weather_view",
    "observation_view",
    "station_view",
    "county_edge_view",
]
