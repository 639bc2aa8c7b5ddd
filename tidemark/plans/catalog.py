"""All registered queries."""

from tidemark.plans import models, monitoring, rows, sequences, streams  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
