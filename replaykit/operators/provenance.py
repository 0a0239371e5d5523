"""Lookups over the artifact and load provenance ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import PAIR, history, newest_per


def artifact_by_id(artifacts: DataFrame, ids: DataFrame) -> DataFrame:
    """At most one artifact row per requested id; unknown ids yield nothing.

    A retried insert may leave equal copies of a row, so the newest is taken.
    """
    wanted = artifacts.join(ids.select("provenance_id").distinct(), "provenance_id", "left_semi")
    return newest_per(wanted, ["provenance_id"], "run_id")


def artifact_history(artifacts: DataFrame, pairs: DataFrame) -> DataFrame:
    return history(artifacts, pairs, "provenance_id")


def artifact_by_uri(artifacts: DataFrame) -> DataFrame:
    """Newest artifact of every (date, source, URI)."""
    return newest_per(artifacts, [*PAIR, "gcs_uri"], "provenance_id")


def load_history(loads: DataFrame, pairs: DataFrame) -> DataFrame:
    return history(loads, pairs, "load_id")


def latest_load(loads: DataFrame) -> DataFrame:
    return newest_per(loads, PAIR, "load_id")


def lineage(loads: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Each load with the exact artifact it consumed; orphan loads keep null artifact columns."""
    facts = artifacts.select(
        "provenance_id",
        F.col("delivery_date").alias("artifact_delivery_date"),
        F.col("source_object").alias("artifact_source_object"),
        "ingestion_date",
        "gcs_uri",
        "checksum",
        "file_size_bytes",
        "record_count",
    )
    return loads.join(facts, "provenance_id", "left").withColumn(
        "is_orphan", F.col("artifact_delivery_date").isNull()
    )
