"""All registered queries (importing the modules registers them)."""

from martloom.plans import (  # noqa: F401
    change_queries,
    mart_queries,
    relational_queries,
    source_queries,
    time_queries,
    typing_queries,
)
from martloom.plans.suite import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
