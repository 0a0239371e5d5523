"""Replay of a date range: every date and source in a handful of Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches, ledger
from ..operators.ledger import PAIR
from ..session import written_table
from ..sources.registry import DAILY_SOURCES
from ..sources.tables import create_ledger
from .attempts import (
    Clock,
    RowsOf,
    Stamps,
    append_artifacts,
    append_events,
    append_loads,
    attempt_of,
    derived_id,
    load_sources,
    utc_now,
    with_loads,
)
from .ingest import delivered_rows, deliveries_of, judge, land

LANDING_FACTS = ("ingestion_date", "gcs_uri", "checksum", "file_size_bytes", "record_count")


def attempted_days(days: DataFrame, deliveries: DataFrame, outcomes: DataFrame, events: DataFrame) -> DataFrame:
    """Dates a range reaches, with whether their batch may be worked on.

    A range stops at its first date that cannot become complete: its batch is
    rejected, or a source neither completed before nor was ingested now.
    """
    accepted = batches.membership(deliveries, days).select("delivery_date", "accepted")
    before = ledger.logical_completion(events).select(*PAIR)
    now = outcomes.filter(F.col("status") == "success").select(*PAIR)
    reachable = before.unionByName(now).distinct().withColumn("status", F.lit("success"))
    daily = (
        ledger.completeness(reachable, days)
        .join(accepted, "delivery_date")
        .select(
            "delivery_date",
            "accepted",
            (F.col("complete") & F.col("accepted")).alias("complete"),
            F.lit(0).alias("range_id"),
        )
    )
    return ledger.range_progress(daily).filter(F.col("progress") != "not_attempted")


def replay_range(
    spark: SparkSession,
    database: str,
    days: DataFrame,
    deliveries: DataFrame,
    outcomes: DataFrame,
    rows_of: RowsOf,
    run_id: str,
    clock: Clock = utc_now,
) -> DataFrame:
    """Replay the requested days and return the progress of each.

    ``deliveries`` are delivered (date, source) rows, ``outcomes`` one
    ingestion outcome per pair with its landing facts, ``rows_of`` gives a
    source's raw rows with their ``delivery_date``.  Ingestion of every source
    comes before any load.  Running it again replaces the same partitions and
    appends under its own run id.
    """
    stamp = Stamps(clock)
    started = stamp()
    events = create_ledger(spark, database, "replay_events")
    reached = attempted_days(days, deliveries, outcomes, ledger_of(spark, events, days))
    work = reached.filter("accepted").select("delivery_date")
    expected = F.col("source_object").isin(*DAILY_SOURCES)
    attempts = written_table(
        outcomes.filter(expected)
        .join(work, "delivery_date", "left_semi")
        .select(
            *PAIR,
            (F.col("status") == "success").alias("ingest_ok"),
            "error_message",
            *LANDING_FACTS,
            derived_id(run_id, "artifact", attempt_of(started)).alias("provenance_id"),
        ),
        "replay",
    )
    steps = ledger.replay_steps(F.col("ingest_ok"), F.lit(True))
    append_events(attempts, steps, F.col("step") == 0, database, run_id, started, started)
    ingested = attempts.filter("ingest_ok")
    append_artifacts(ingested, database, run_id, stamp())
    append_events(attempts, steps, F.col("step") == 1, database, run_id, started, stamp())
    loaded = with_loads(attempts, F.col("ingest_ok"), load_sources(ingested, database, rows_of))
    append_loads(loaded.filter("load_ok"), database, run_id, attempt_of(started), stamp())
    steps = ledger.replay_steps(F.col("ingest_ok"), F.col("load_ok"))
    append_events(loaded, steps, F.col("step") == 2, database, run_id, started, stamp())
    return range_status(ledger_of(spark, events, days), days)


def replay_files(
    spark: SparkSession,
    database: str,
    root: str,
    days: DataFrame,
    ingestion_date: Column,
    store: str,
    run_id: str,
    clock: Clock = utc_now,
) -> DataFrame:
    """Replay the requested days from a folder of delivered files, and return the progress of each.

    All files are judged in one job.  Only files of days that the range reaches are landed, and get a claim and a run row;
    the tables are then loaded from them.  Later days stay as if they had not been delivered.
    """
    stamp = Stamps(clock)
    started = stamp()
    outcomes = judge(spark, database, root, ingestion_date, run_id)
    pairs = written_table(deliveries_of(outcomes, store), "deliveries")
    events = spark.table(create_ledger(spark, database, "replay_events"))
    reached = attempted_days(days, pairs, pairs, events).filter("accepted").select("delivery_date")
    land(outcomes.join(reached, "delivery_date", "left_semi"), database, run_id, started, stamp())
    return replay_range(spark, database, days, pairs, pairs, delivered_rows(spark, root, outcomes), run_id, clock)


def refusals(days: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Requested days whose batch is refused as a whole, with the names of what is missing and what nobody expects."""
    judged = batches.membership(deliveries, days).filter(~F.col("accepted"))
    return judged.select("delivery_date", "missing_sources", "unexpected_sources")


def ledger_of(spark: SparkSession, table: str, days: DataFrame) -> DataFrame:
    """Ledger rows of the requested days, read from their partitions alone.

    The days of a range come to the driver, one date each.
    """
    listed = sorted(row[0] for row in days.select("delivery_date").distinct().collect())
    return spark.table(table).filter(F.col("delivery_date").isin(listed))


def range_status(events: DataFrame, days: DataFrame) -> DataFrame:
    """Completeness of each requested day and where the range stopped."""
    daily = ledger.date_completeness(events, days).withColumn("range_id", F.lit(0))
    return ledger.range_progress(daily).drop("range_id")

