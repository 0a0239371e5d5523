"""Collects the registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from replaykit.session import scratch_if_unset

from .bindings import plain

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def bound(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            scratch_if_unset(spark)
            return plain(run(spark, sf))

        bound.__name__ = name
        QUERIES[name] = bound
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register
