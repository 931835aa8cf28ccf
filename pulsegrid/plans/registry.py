"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import data_quality, telemetry

MODULES = (data_quality, telemetry)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for module in MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
