"""Interaction analytics on Spark: slices, deltas, splits, sequences, models, gates and drift."""

from tidemark.config import EngineConfig
from tidemark.session import configure

__all__ = ["EngineConfig", "configure"]
