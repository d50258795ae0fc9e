"""Named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where
SQL can express the result, the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from rateflow.plans import offline, content, online, factor, io_checks, streams  # noqa: F401
