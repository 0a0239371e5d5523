"""Sinks: raw tables replaced whole or by day, and append-only ledger tables.

All writes go through ``rebalance`` on the partition column: AQE splits a day
that holds most of the rows over several tasks and joins small days, so neither
one task nor thousands of tiny files carry a load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import destination_id
from ..session import drop_tables, written_so_far, written_table
from .registry import MASTER, SOURCES, columns_of, is_transactional

PARTITION = "delivery_date"
DDL_BATCH = 500

# Key, columns in stored order, and partition column of each ledger.
LEDGERS: dict[str, tuple[str, str, str]] = {
    "replay_events": (
        "event_id",
        "run_id string, event_id string, delivery_date date, source_object string, status string, "
        "stage string, started_at timestamp, completed_at timestamp, error_message string, "
        "recorded_at timestamp",
        PARTITION,
    ),
    "artifact_provenance": (
        "provenance_id",
        "provenance_id string, run_id string, delivery_date date, source_object string, "
        "ingestion_date date, gcs_uri string, checksum string, file_size_bytes bigint, "
        "record_count bigint, recorded_at timestamp",
        PARTITION,
    ),
    "load_provenance": (
        "load_id",
        "load_id string, provenance_id string, run_id string, delivery_date date, "
        "source_object string, destination string, partition_date date, output_rows bigint, "
        "job_id string, recorded_at timestamp",
        PARTITION,
    ),
    "landing_manifest": (
        "landing_path",
        "landing_path string, path string, source_system string, source_object string, source_file_name string, "
        "delivery_date date, checksum string, file_size_bytes bigint, record_count bigint, claim_id string, "
        "landed_at timestamp, ingestion_date date",
        "ingestion_date",
    ),
    "ingestion_runs": (
        "ingestion_id",
        "ingestion_id string, source_system string, source_object string, source_file_name string, "
        "started_at timestamp, completed_at timestamp, landing_path string, file_size_bytes bigint, checksum string, "
        "record_count bigint, status string, error_message string, schema_version string, run_day date",
        "run_day",
    ),
}


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    clause = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{clause}")


def create_ledger(spark: SparkSession, database: str, ledger: str) -> str:
    """Create the ledger if absent, one partition per day."""
    table = f"{database}.{ledger}"
    _, columns, partition = LEDGERS[ledger]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({partition})")
    return table


def create_raw_table(spark: SparkSession, database: str, source_object: str) -> str:
    """Create a source-shaped all-text table; daily sources get a date partition.

    Overwriting by partition is a property of the daily tables, so no session
    setting has to change around a write (``insertInto`` ignores write options).
    """
    table = f"{database}.{source_object}"
    columns = ", ".join(f"`{name}` string" for name in columns_of(source_object))
    if SOURCES[source_object][1] == MASTER:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    else:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {PARTITION} date) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({PARTITION})"
        )
    return table


def append_ledger(rows: DataFrame, database: str, ledger: str) -> None:
    """Insert rows whose id is new; a repeated append changes nothing.

    The rows are computed once, into the shared folder.  Only the partitions of their days are read back, and rows are sorted
    by source inside each file so that Parquet statistics prune lookups.  Ids alone tell whether any row is new; only then do rows move,
    once by id for both the lookup and the copies, and once by day for the write.
    """
    spark = rows.sparkSession
    table = create_ledger(spark, database, ledger)
    key, _, partition = LEDGERS[ledger]
    stored = spark.table(table)
    fresh = written_table(rows.select(*stored.columns), "append")
    days = sorted(row[0] for row in fresh.select(partition).distinct().collect())
    known = stored.filter(F.col(partition).isin(days)).select(key)
    if days and not fresh.select(key).join(known, key, "left_anti").isEmpty():
        new = fresh.join(known, key, "left_anti").dropDuplicates([key]).select(*stored.columns)
        new.hint("rebalance", partition).sortWithinPartitions(partition, "source_object").write.mode("append").insertInto(table)
    drop_tables(spark, written_so_far()[-1:])


def replace_master(rows: DataFrame, database: str, source_object: str) -> str:
    """Replace the whole table; running it twice leaves the same table."""
    table = create_raw_table(rows.sparkSession, database, source_object)
    rows.select(*columns_of(source_object)).hint("rebalance").write.mode("overwrite").insertInto(table)
    return table


def _partition_ddl(spark: SparkSession, table: str, verb: str, days: list[dt.date], separator: str) -> None:
    for start in range(0, len(days), DDL_BATCH):
        specs = separator.join(f"PARTITION ({PARTITION}=DATE'{day}')" for day in days[start:start + DDL_BATCH])
        spark.sql(f"ALTER TABLE {table} {verb} {specs}")


def clear_partitions(spark: SparkSession, table: str, days: Iterable[dt.date]) -> None:
    """Empty the given days but keep them registered: zero rows is not the same as absent."""
    listed = sorted(days)
    _partition_ddl(spark, table, "DROP IF EXISTS", listed, ", ")
    _partition_ddl(spark, table, "ADD IF NOT EXISTS", listed, " ")


def replace_partitions(rows: DataFrame, database: str, source_object: str, days: DataFrame | list[dt.date]) -> str:
    """Replace exactly the given days, in one write for all of them.

    ``rows`` carries ``delivery_date``; rows of other days are not written.  The
    days, one date each, come to the driver first unless they are there, so they prune partitioned input.
    Dynamic overwrite leaves a day without rows as it was, so the write
    observes which days it filled and the others (a list of dates, one per day
    at most) are emptied after it.  The rows are computed once.
    """
    spark = rows.sparkSession
    table = create_raw_table(spark, database, source_object)
    wanted = days if isinstance(days, list) else sorted(row[0] for row in days.select(PARTITION).distinct().collect())
    kept = rows.filter(F.col(PARTITION).isin(wanted)).select(*columns_of(source_object), PARTITION)
    seen = Observation()
    observed = kept.observe(seen, F.collect_set(PARTITION).alias("days"))
    ordered = observed.hint("rebalance", PARTITION).sortWithinPartitions(PARTITION)
    ordered.write.mode("overwrite").insertInto(table)
    try:
        filled = set(seen.get.get("days") or ())
    except Py4JJavaError:
        # where Spark finds at run time that there are no rows, it takes the observation out of the plan
        if not kept.isEmpty():
            raise
        filled = set()
    clear_partitions(spark, table, [day for day in wanted if day not in filled])
    return table


def registered_partitions(spark: SparkSession, database: str, source_object: str) -> DataFrame:
    """Registered days of a table, including days without rows."""
    listed = spark.sql(f"SHOW PARTITIONS {database}.{source_object}")
    day = F.regexp_extract("partition", f"{PARTITION}=(.*)$", 1).cast("date")
    return listed.select(F.lit(source_object).alias("source_object"), day.alias("partition_date"))


def partition_counts(
    spark: SparkSession, database: str, source_object: str, days: list[dt.date] | None = None
) -> DataFrame:
    """Rows per day, of the given days or of all; only file footers and the partition column are read."""
    table = spark.table(f"{database}.{source_object}")
    if days is not None:
        table = table.filter(F.col(PARTITION).isin(days))
    counted = table.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.lit(source_object).alias("source_object"), F.col(PARTITION).alias("partition_date"), "n"
    )


def load_results(expected: DataFrame, counts: DataFrame, dataset: str, uri: Column, job_id: str) -> DataFrame:
    """Load facts of every expected (source, date); zero rows is a success.

    Master sources are loaded under their date as well but into the whole table.
    """
    joined = expected.join(
        counts.withColumnRenamed("partition_date", "delivery_date"), ["source_object", "delivery_date"], "left"
    )
    source, day = F.col("source_object"), F.col("delivery_date")
    return joined.select(
        "source_object",
        uri.alias("source_uri"),
        destination_id(dataset, source, day, is_transactional(source)).alias("destination"),
        day.alias("partition_date"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("output_rows"),
        F.lit(job_id).alias("job_id"),
    )
