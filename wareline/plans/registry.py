"""Registered queries. Each has, where SQL can say it, an equivalent text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wareline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is what must give the same rows."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select
