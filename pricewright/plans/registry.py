"""Registered queries: each Spark plan next to its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan; ``sql`` is the DuckDB statement that must give the same rows."""

    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            CHECKS[name] = sql
        return plan

    return register
