"""All registered queries."""

from weatherloom.plans import (  # noqa: F401
    layout_queries,
    observation_queries,
    rainfall_queries,
    source_queries,
    station_queries,
)
from weatherloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
