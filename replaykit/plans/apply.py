"""Applying a recovery plan: one job per kind of work, not one per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_error
from ..operators import batches, provenance, recovery
from ..operators.ledger import PAIR
from ..session import written_table
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
from .replay import LANDING_FACTS


def _refuse(problems: DataFrame, what: str) -> None:
    """Raise with every problem in order; they are no more than the pairs of the plan and the request."""
    named = sorted(" ".join(str(v) for v in row) for row in problems.collect())
    if named:
        raise ValueError(f"{what}: {'; '.join(named)}")


def _load_error() -> Column:
    category, component = "warehouse_load_failed", "recovery"
    unknown = "No durable Raw artifact provenance found for supplied artifact"
    return F.when(
        F.col("provenance_id").isNull(), safe_error(category, component, "load_only", unknown)
    ).otherwise(safe_error(category, component, "load", "Warehouse load failed during recovery"))


def check_request(plan: DataFrame, supplied: DataFrame, deliveries: DataFrame) -> None:
    """Refuse a malformed request before any side effect."""
    _refuse(recovery.request_checks(plan, supplied), "artifact request")
    needed = plan.filter(F.col("action") == "ingest_and_load").select(*PAIR)
    unresolved = batches.resolve(needed, deliveries).filter(F.col("resolution") != "ok")
    _refuse(unresolved.select("resolution", *PAIR), "deliveries")


def apply_plan(
    spark: SparkSession,
    database: str,
    plan: DataFrame,
    supplied: DataFrame,
    deliveries: DataFrame,
    outcomes: DataFrame,
    reconciled: DataFrame,
    rows_of: RowsOf,
    run_id: str,
    clock: Clock = utc_now,
) -> DataFrame:
    """Carry out a plan and return one result row per planned pair.

    ``supplied`` are the validated artifacts for reuse, ``outcomes`` the
    ingestion outcomes of freshly delivered pairs, ``reconciled`` the verdicts.
    A reused artifact without durable provenance fails before any load.
    """
    check_request(plan, supplied, deliveries)
    stamp = Stamps(clock)
    started = stamp()
    attempt = attempt_of(started)
    create_ledger(spark, database, "replay_events")
    known = provenance.artifact_by_uri(spark.table(create_ledger(spark, database, "artifact_provenance")))
    known = known.select(*PAIR, "gcs_uri", F.col("provenance_id").alias("known_id"))
    reusable = supplied.select(*PAIR, "gcs_uri").join(known, [*PAIR, "gcs_uri"], "left").select(*PAIR, "known_id")
    fresh = outcomes.select(*PAIR, F.col("status").alias("ingest_status"), "error_message", *LANDING_FACTS)
    verdicts = reconciled.select(*PAIR, F.col("outcome").alias("verdict"))
    action = F.col("action")
    joined = (
        plan.select(*PAIR, "action")
        .join(reusable, list(PAIR), "left")
        .join(fresh, list(PAIR), "left")
        .join(verdicts, list(PAIR), "left")
    )
    ingesting = action == "ingest_and_load"
    ingest_ok = F.coalesce(F.col("ingest_status") == "success", F.lit(False))
    attempts = written_table(
        joined.select(
            *PAIR,
            "action",
            (ingesting & ingest_ok).alias("ingest_ok"),
            F.when(ingesting, F.coalesce("ingest_status", F.lit("failed"))).alias("ingest_status"),
            "error_message",
            *LANDING_FACTS,
            F.when(action == "load_only", F.col("known_id"))
            .when(ingesting, derived_id(run_id, "artifact", attempt))
            .alias("provenance_id"),
            F.coalesce((action == "reconcile") & (F.col("verdict") == "confirmed"), F.lit(False)).alias("confirmed"),
        ),
        "recovery",
    )
    loadable = (action == "load_only") & F.col("provenance_id").isNotNull() | F.col("ingest_ok")

    def record(flagged: DataFrame, keep: Column) -> None:
        append_events(
            flagged, recovery.recovery_steps(), keep, database, run_id, started, stamp(), _load_error()
        )

    step = F.col("step")
    assumed = attempts.withColumn("load_ok", F.lit(True))
    record(assumed, (step == 0) & (action != "reconcile"))
    append_artifacts(attempts.filter("ingest_ok"), database, run_id, stamp())
    record(assumed, (step == 1) & (action == "ingest_and_load"))
    loaded = with_loads(attempts, loadable, load_sources(attempts.filter(loadable), database, rows_of))
    append_loads(loaded.filter("load_ok"), database, run_id, attempt, stamp())
    last = (
        ((action == "load_only") & (step == 1))
        | ((action == "ingest_and_load") & (step == 2))
        | (action == "reconcile")
    )
    record(loaded, last)
    return (
        loaded.withColumn("outcome", recovery.result_outcome())
        .select(
            *PAIR,
            "action",
            "outcome",
            F.coalesce("ingest_status", F.lit("none")).alias("ingest_status"),
            F.col("load_ok").alias("has_load"),
            F.when(action != "reconcile", "none")
            .otherwise(F.when(F.col("confirmed"), "confirmed").otherwise("blocked"))
            .alias("reconciliation"),
        )
    )


def recover_files(
    spark: SparkSession,
    database: str,
    root: str,
    plan: DataFrame,
    supplied: DataFrame,
    reconciled: DataFrame,
    ingestion_date: Column,
    store: str,
    run_id: str,
    clock: Clock = utc_now,
) -> DataFrame:
    """Apply a plan whose fresh deliveries lie as files below a root; only files of planned ingestions are landed."""
    stamp = Stamps(clock)
    started = stamp()
    outcomes = judge(spark, database, root, ingestion_date, run_id)
    pairs = written_table(deliveries_of(outcomes, store), "deliveries")
    check_request(plan, supplied, pairs)
    needed = plan.filter(F.col("action") == "ingest_and_load").select(*PAIR)
    land(outcomes.join(needed, list(PAIR), "left_semi"), database, run_id, started, stamp())
    rows = delivered_rows(spark, root, outcomes)
    return apply_plan(spark, database, plan, supplied, pairs, pairs, reconciled, rows, run_id, clock)


def recovery_summary(spark: SparkSession, database: str, results: DataFrame) -> DataFrame:
    """Counts per day with completeness re-read from the ledger."""
    return recovery.outcome_summary(results, spark.table(f"{database}.replay_events"))

