"""Registered queries over the driver's tables, each with its SQL oracle where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runlens.plans.catalog.registry import ORACLES, QUERIES, oracle_text
from runlens.plans.catalog import (  # noqa: F401  (importing registers the queries)
    answers,
    builds,
    files,
    runs,
    scores,
    states,
    streams,
    texts,
    traces,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: oracle_text(name) for name in ORACLES}
