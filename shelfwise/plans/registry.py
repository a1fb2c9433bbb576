"""The query registry."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import apply_settings

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan and, where one exists, the SQL text that gives the same rows."""

    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(plan)
        def with_settings(spark: SparkSession, folder: str) -> DataFrame:
            apply_settings(spark)
            return plan(spark, folder)

        QUERIES[name] = with_settings
        if sql is not None:
            CHECKS[name] = sql
        return plan

    return register
