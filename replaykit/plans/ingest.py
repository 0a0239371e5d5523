"""Delivered files to landed artifacts: contract, count, digest, landing claim and run row, in one job for all files.

The landing manifest is a stored table.  A landing path is claimed by inserting it where it is absent; a claim carries an id made
of run and file, so a run repeated after a crash finds its own claims and is no conflict to itself, while any other run is.  Claims
are written before run rows, and one writer per ingestion date is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_error
from ..operators.runs import RUN_COLUMNS, classify
from ..session import written_table
from ..sources.deliveries import file_checks, file_facts, header_contract, record_counts, scan_csv
from ..sources.landing import landing_conflicts, landing_manifest
from ..sources.registry import columns_of
from ..sources.tables import LEDGERS, append_ledger, create_ledger
from .attempts import Clock, RowsOf, Stamps, utc_now

SCHEMA_VERSION = "1"


def stored_manifest(spark: SparkSession, database: str, dates: DataFrame) -> DataFrame:
    """Landing claims of the given ingestion dates; only their partitions are read.  The dates come to the driver."""
    listed = sorted(row[0] for row in dates.select("ingestion_date").distinct().collect() if row[0] is not None)
    return spark.table(create_ledger(spark, database, "landing_manifest")).filter(F.col("ingestion_date").isin(listed))


def judge(spark: SparkSession, database: str, root: str, ingestion_date: Column, run_id: str) -> DataFrame:
    """Contract, count, digest and landing path of every file below a root; one row per file with its outcome, nothing landed yet.

    ``ingestion_date`` is a Column over the file rows (``source_object``, ``delivery_date``, ``path``).
    """
    facts = file_facts(spark, root)
    checked = header_contract(file_checks(facts.drop("file_size_bytes"), facts)).withColumn("ingestion_date", ingestion_date)
    good = (F.col("file_check") == "ok") & F.coalesce("valid_utf8", F.lit(False)) & F.col("header_ok")
    judged = checked.withColumn("valid", good)
    digests = landing_manifest(spark, root, judged.filter("valid")).select("path", "landing_path", "checksum")
    named = written_table(
        judged.join(digests, "path", "left")
        .join(record_counts(spark, root, facts).select("path", "record_count"), "path", "left")
        .withColumn("claim_id", F.sha2(F.concat_ws("|", F.lit(run_id), "path"), 256)),
        "judged-files",
    )
    others = stored_manifest(spark, database, named).join(named.select("claim_id"), "claim_id", "left_anti")
    landed = landing_conflicts(named.filter("valid").select("path", "landing_path"), others)
    flagged = named.join(landed.select("path", (~F.col("conflict")).alias("landed")), "path", "left")
    return written_table(classify(flagged.withColumn("counted", F.col("record_count") >= 0)), "ingestion-outcomes")


def land(outcomes: DataFrame, database: str, run_id: str, started_at: Column, landed_at: Column) -> None:
    """Store the claims of files that land, then a run row for every file, with the times at which the job began and had judged it."""
    claims = outcomes.filter("status = 'success'").withColumn("landed_at", landed_at)
    append_ledger(claims, database, "landing_manifest")
    append_ledger(run_rows(outcomes, run_id, started_at, landed_at), database, "ingestion_runs")


def ingest(
    spark: SparkSession, database: str, root: str, ingestion_date: Column, run_id: str, clock: Clock = utc_now
) -> DataFrame:
    """Judge and land every file below a root."""
    stamp = Stamps(clock)
    started = stamp()
    outcomes = judge(spark, database, root, ingestion_date, run_id)
    land(outcomes, database, run_id, started, stamp())
    return outcomes


def run_rows(outcomes: DataFrame, run_id: str, started_at: Column, completed_at: Column) -> DataFrame:
    """The run row of every file, under an id that repeats when the run is repeated at the same time."""
    key = F.sha2(F.concat_ws("|", F.lit(run_id), "path", F.unix_micros(started_at).cast("string")), 256)
    values = {"ingestion_id": key, "started_at": started_at, "completed_at": completed_at, "schema_version": F.lit(SCHEMA_VERSION)}
    picked = [values.get(c, F.col(c)).alias(c) for c in RUN_COLUMNS]
    return outcomes.select(*picked, started_at.cast("date").alias(LEDGERS["ingestion_runs"][2]))


def deliveries_of(outcomes: DataFrame, store: str) -> DataFrame:
    """Outcome of every delivered (date, source), its artifact named below ``store``.

    A source delivers one file a day, so a second one makes the delivery ambiguous, and it fails.
    """
    single = F.count(F.lit(1)) == 1
    facts = ("ingestion_date", "checksum", "file_size_bytes", "record_count")
    ambiguous = safe_error("source_validation_failed", "delivery", "resolve_file", "Ambiguous delivery")
    return outcomes.filter("delivery_date IS NOT NULL").groupBy("delivery_date", "source_object").agg(
        F.when(single & (F.max("status") == "success"), "success").otherwise("failed").alias("status"),
        F.when(~single, ambiguous).otherwise(F.max("error_message")).alias("error_message"),
        F.when(single, F.concat(F.lit(f"{store.rstrip('/')}/"), F.max("landing_path"))).alias("gcs_uri"),
        *[F.when(single, F.max(name)).alias(name) for name in facts],
    )


def delivered_rows(spark: SparkSession, root: str, outcomes: DataFrame) -> RowsOf:
    """Raw rows of a source, with the delivery date in their file's path, read by the facts of the files that landed."""
    day = F.regexp_extract("path", r"/delivery_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$", 1).cast("date")

    def rows(source: str) -> DataFrame:
        landed = outcomes.filter((F.col("source_object") == source) & (F.col("status") == "success"))
        scanned = scan_csv(spark, f"{root}/{source}", source, landed)
        return scanned.select(*columns_of(source), day.alias("delivery_date"))

    return rows
