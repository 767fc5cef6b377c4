"""Queries over the star schema, each with its SQL for DuckDB."""

from larkspan.plans.registry import ORACLES, QUERIES
from larkspan.plans import changes, depth, late, more, outside, relational, scalars, star, times  # noqa: F401,E402  they register their queries

__all__ = ["ORACLES", "QUERIES"]
