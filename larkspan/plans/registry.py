"""Where queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspan.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Registers a function of the tables under its name, with the SQL that gives the same rows."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[plan.__name__] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
        if sql:
            ORACLES[plan.__name__] = sql
        return plan

    return register
