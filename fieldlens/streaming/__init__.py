"""Structured Streaming: incremental refresh of derived tables."""

from fieldlens.streaming.refresh import GoldRefresher

__all__ = ["GoldRefresher"]
