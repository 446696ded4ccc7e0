"""Column-level helpers (built-in expressions only, no Python UDFs)."""

from fieldlens.functions.exprs import (
    clean_temperature,
    yield_status,
    geoid,
    hash_bucket,
    pct_change,
    prefix_flag,
    dict_lookup,
    fixed_text,
)

__all__ = [
    "clean_temperature",
    "yield_status",
    "geoid",
    "hash_bucket",
    "pct_change",
    "prefix_flag",
    "dict_lookup",
    "fixed_text",
]
