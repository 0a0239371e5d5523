"""Does the recorded evidence prove that a load really happened?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import uri_ingestion_date
from .ledger import PAIR
from .provenance import latest_load

# Neutral names of the stored reason codes, for display.
DISPLAY_REASONS = {
    "gcs_artifact_missing": "raw_artifact_missing",
    "gcs_checksum_missing": "raw_checksum_missing",
    "gcs_checksum_mismatch": "raw_checksum_mismatch",
    "gcs_size_mismatch": "raw_size_mismatch",
    "gcs_ingestion_date_mismatch": "raw_ingestion_date_mismatch",
    "bigquery_partition_missing": "table_partition_missing",
    "bigquery_destination_mismatch": "table_destination_mismatch",
    "bigquery_row_count_mismatch": "table_row_count_mismatch",
}


def display_reason(reason: Column) -> Column:
    chain = reason
    for code, name in DISPLAY_REASONS.items():
        chain = F.when(reason == code, name).otherwise(chain)
    return chain


def _differs(left: str, right: str) -> Column:
    return ~F.col(left).eqNullSafe(F.col(right))


def evidence_chain(
    pairs: DataFrame,
    loads: DataFrame,
    artifacts: DataFrame,
    artifact_observations: DataFrame,
    partition_observations: DataFrame,
) -> DataFrame:
    """One row per pair holding every fact the decision reads, nulls where a link is absent."""
    load = latest_load(loads).select(
        *PAIR, "load_id", "provenance_id", "destination", "partition_date", "output_rows"
    )
    artifact = artifacts.select(
        "provenance_id",
        F.col("provenance_id").alias("artifact_id"),
        F.col("delivery_date").alias("artifact_date"),
        F.col("source_object").alias("artifact_source"),
        "ingestion_date",
        "gcs_uri",
        "checksum",
        "file_size_bytes",
        "record_count",
    )
    seen = artifact_observations.select(
        "gcs_uri",
        F.col("present").alias("artifact_present"),
        F.col("checksum").alias("seen_checksum"),
        F.col("file_size_bytes").alias("seen_size"),
    )
    table = partition_observations.select(
        F.col("partition_date").alias("delivery_date"),
        "source_object",
        F.col("present").alias("partition_present"),
        F.col("destination").alias("seen_destination"),
        F.col("row_count").alias("seen_rows"),
    )
    return (
        pairs.select(*PAIR)
        .distinct()
        .join(load, list(PAIR), "left")
        .join(artifact, "provenance_id", "left")
        .join(seen, "gcs_uri", "left")
        .join(table, list(PAIR), "left")
    )


def reconcile(
    pairs: DataFrame,
    loads: DataFrame,
    artifacts: DataFrame,
    artifact_observations: DataFrame,
    partition_observations: DataFrame,
) -> DataFrame:
    """Confirm or block each pair; the first failing link of the chain is the reason.

    Comparisons are null-safe: an absent fact is a mismatch, never a match.  A
    confirmed row names the two records that prove it, a blocked row names none.
    """
    chain = evidence_chain(pairs, loads, artifacts, artifact_observations, partition_observations)
    uri_date = uri_ingestion_date(F.col("gcs_uri"))
    reason = (
        F.when(F.col("load_id").isNull(), "no_warehouse_load_provenance")
        .when(F.col("artifact_id").isNull(), "no_artifact_provenance")
        .when(
            _differs("partition_date", "delivery_date")
            | _differs("artifact_date", "delivery_date")
            | _differs("artifact_source", "source_object"),
            "provenance_identity_mismatch",
        )
        .when(~F.coalesce("artifact_present", F.lit(False)), "gcs_artifact_missing")
        .when(F.col("seen_checksum").isNull(), "gcs_checksum_missing")
        .when(_differs("seen_checksum", "checksum"), "gcs_checksum_mismatch")
        .when(_differs("seen_size", "file_size_bytes"), "gcs_size_mismatch")
        .when(~uri_date.eqNullSafe(F.col("ingestion_date")) | uri_date.isNull(), "gcs_ingestion_date_mismatch")
        .when(~F.coalesce("partition_present", F.lit(False)), "bigquery_partition_missing")
        .when(_differs("seen_destination", "destination"), "bigquery_destination_mismatch")
        .when(
            _differs("seen_rows", "output_rows") | _differs("output_rows", "record_count"),
            "bigquery_row_count_mismatch",
        )
        .otherwise("confirmed")
    )
    judged = chain.withColumn("reason", reason)
    confirmed = F.col("reason") == "confirmed"
    return judged.select(
        *PAIR,
        F.when(confirmed, "confirmed").otherwise("blocked").alias("outcome"),
        "reason",
        F.when(confirmed, F.col("artifact_id")).alias("provenance_id"),
        F.when(confirmed, F.col("load_id")).alias("load_id"),
    )
