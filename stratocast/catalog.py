"""Queries of the engine and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratocast.plans import lists, publishing, reports, stations, tiers, training, verification

MODULES = (training, verification, stations, tiers, publishing, lists, reports)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.O.items()}
