"""Scalar expressions of the pipeline, built from ``pyspark.sql.functions``.

All of them stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_temperature(tavg: Column | str = "TAVG", tmax: Column | str = "TMAX",
                      tmin: Column | str = "TMIN") -> Column:
    """Daily mean temperature, falling back to the max/min mid-point."""
    return F.coalesce(_c(tavg), (_c(tmax) + _c(tmin)) / 2)


# The three yield labels and the +-5 % band around the trailing
# average that separates them.
GOOD, AVERAGE, POOR = "Good", "Average", "Poor"
BAND_HIGH, BAND_LOW = 1.05, 0.95


def yield_status(y: Column | str = "Yield_Per_Acre",
                 avg: Column | str = "5_Year_Avg_Yield") -> Column:
    """C4: Good above the band, Poor below, Average otherwise (and when the
    trailing average is null)."""
    y, avg = _c(y), _c(avg)
    return (
        F.when(y > avg * BAND_HIGH, F.lit(GOOD))
        .when(y < avg * BAND_LOW, F.lit(POOR))
        .otherwise(F.lit(AVERAGE))
    )


def geoid(state_fips: Column | str, county_fips: Column | str) -> Column:
    """5-digit county key from zero-padded state (2) and county (3) codes."""
    return F.concat(
        F.lpad(_c(state_fips).cast("string"), 2, "0"),
        F.lpad(_c(county_fips).cast("string"), 3, "0"),
    )


def hash_bucket(key: Column, buckets: int, salt: int = 0) -> Column:
    """Deterministic bucket of a row key from 8 hex digits of its MD5.

    ``salt`` picks which 8 hex digits are used, so independent splits (hold-out
    vs. folds) use independent digits.  Reproducible on any engine with MD5.
    MD5 has 32 hex digits, so ``salt`` is 0 to 3 (ValueError beyond).
    """
    if not 0 <= salt <= 3:
        raise ValueError("salt must be 0, 1, 2 or 3")
    start = 1 + 8 * salt
    hexd = F.substring(F.md5(key.cast("string")), start, 8)
    return F.pmod(F.conv(hexd, 16, 10).cast("bigint"), F.lit(buckets))


def pct_change(new: Column | str, base: Column | str) -> Column:
    """(new - base) / base * 100; null (not an error) for a zero/null base."""
    new, base = _c(new), _c(base)
    return F.try_divide(new - base, base) * 100


def prefix_flag(c: Column | str, prefix: str) -> Column:
    """Boolean flag for a string prefix."""
    return _c(c).startswith(prefix)


def dict_lookup(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """C11: map through an inline dictionary; a miss gives null."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)[_c(c)]


# Full state names and their postal abbreviations.
STATE_ABBREV = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH",
    "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC",
    "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN",
    "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def state_key(c: Column | str) -> Column:
    """A state as its abbreviation: full names are mapped, anything else (an
    abbreviation already) stays.  Both sides of a county join use it."""
    return F.coalesce(dict_lookup(c, STATE_ABBREV), _c(c))


def fixed_text(x: Column | str, decimals: int) -> Column:
    """A number as fixed-decimal text (half-up rounding, no grouping)."""
    return F.format_string(f"%.{decimals}f", F.round(_c(x).cast("double"), decimals))
