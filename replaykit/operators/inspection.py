"""Physical state from listings and catalogs; business columns are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import destination_id
from ..sources.registry import is_transactional


def artifact_observation(uris: DataFrame, listing: DataFrame) -> DataFrame:
    """Presence, recorded checksum and size of each URI.

    ``listing`` is what exists now (``gcs_uri, checksum, file_size_bytes``), its
    checksum recorded at landing; payloads are not read again.  A null checksum
    on a present artifact is an observation of its own.
    """
    found = listing.select("gcs_uri", "checksum", "file_size_bytes", F.lit(True).alias("found"))
    return (
        uris.select("gcs_uri")
        .distinct()
        .join(found, "gcs_uri", "left")
        .select(
            "gcs_uri",
            F.coalesce("found", F.lit(False)).alias("present"),
            "checksum",
            "file_size_bytes",
        )
    )


def partition_observation(pairs: DataFrame, partitions: DataFrame, counts: DataFrame, dataset: str) -> DataFrame:
    """Presence and row count of each (source, date) partition.

    ``partitions`` lists registered partitions, ``counts`` the non-empty ones.
    A registered partition without rows has count 0; an absent one has null.
    """
    keys = ["source_object", "partition_date"]
    wanted = pairs.select("source_object", F.col("delivery_date").alias("partition_date")).distinct()
    listed = partitions.select(*keys, F.lit(True).alias("found"))
    joined = wanted.join(listed, keys, "left").join(counts.select(*keys, "n"), keys, "left")
    present = F.coalesce("found", F.lit(False))
    source, day = F.col("source_object"), F.col("partition_date")
    return joined.select(
        *keys,
        destination_id(dataset, source, day, is_transactional(source)).alias("destination"),
        present.alias("present"),
        F.when(present, F.coalesce("n", F.lit(0).cast("bigint"))).alias("row_count"),
    )
