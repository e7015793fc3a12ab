"""Ready-made queries over the test tables."""

from vicinity.plans import cells, ingest, layout, runs, texts, upkeep, vectors  # noqa: F401
from vicinity.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
