"""Composite pipelines (raw -> bronze -> gold -> model -> scenarios)."""
