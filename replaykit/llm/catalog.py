"""Collects the queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from replaykit.session import scratch_if_unset

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# Rows of an Arrow batch: texts are long, and a batch is held whole on both sides.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Settings that the operators count on."""
    scratch_if_unset(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def bound(spark: SparkSession, sf: str) -> DataFrame:
            prepare(spark)
            return run(spark, sf)

        bound.__name__ = name
        QUERIES[name] = bound
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
