"""Registry of ready-made queries over the test tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from vicinity.session import ship

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function's name, with the SQL that checks it."""

    def add(plan: Plan) -> Plan:
        @wraps(plan)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return plan(spark, sf_dir)

        QUERIES[plan.__name__] = shipped
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan

    return add
