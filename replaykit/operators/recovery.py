"""Which minimum work each incomplete source needs, and what that work recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import constant_table
from ..sources.registry import DAILY_SOURCES
from .ledger import (
    PAIR,
    completeness,
    confirm_steps,
    explode_steps,
    load_steps,
    logical_completion,
    pair_state,
    replay_steps,
)

# The five actions with their reason texts.  The first four are fixed values; the last is worded here.
REASONS = {
    "skip": "source has already logically completed (SUCCESS|WAREHOUSE recorded)",
    "ingest_and_load": "no logical completion and no reusable Raw artifact exists in GCS or BigQuery",
    "load_only": (
        "a valid, reusable GCS Raw artifact exists but BigQuery Raw does not -- "
        "only warehouse loading is needed"
    ),
    "reconcile": (
        "GCS Raw and BigQuery Raw both appear to exist without recorded logical completion -- "
        "ambiguous, must not assume success"
    ),
    "manual_review": (
        "BigQuery Raw exists without a valid GCS Raw artifact, "
        "which is inconsistent with the expected data path"
    ),
}

# Every legal (action, outcome, ingestion status, has load,
# reconciliation outcome).
LEGAL_RESULTS = (
    ("skip", "skipped", "none", False, "none"),
    ("manual_review", "blocked", "none", False, "none"),
    ("reconcile", "succeeded", "none", False, "confirmed"),
    ("reconcile", "blocked", "none", False, "blocked"),
    ("load_only", "succeeded", "none", True, "none"),
    ("load_only", "failed", "none", False, "none"),
    ("ingest_and_load", "succeeded", "success", True, "none"),
    ("ingest_and_load", "failed", "success", False, "none"),
    ("ingest_and_load", "failed", "failed", False, "none"),
    ("ingest_and_load", "failed", "skipped", False, "none"),
    ("ingest_and_load", "failed", "started", False, "none"),
)


def evidence(
    pairs: DataFrame, events: DataFrame, valid_artifacts: DataFrame, partitions: DataFrame
) -> DataFrame:
    """Facts per pair: completion, a reusable landed artifact, a table partition.

    ``valid_artifacts`` holds pairs whose artifact was found intact,
    ``partitions`` is a partition observation.  The latest attempt comes along
    for diagnosis only.
    """
    state = pair_state(events).select(*PAIR, "completed", "latest_status", "latest_stage")
    raw = valid_artifacts.select(*PAIR).distinct().withColumn("raw_found", F.lit(True))
    table = partitions.filter("present").select(
        F.col("partition_date").alias("delivery_date"), "source_object", F.lit(True).alias("table_found")
    )
    no = F.lit(False)
    return (
        pairs.select(*PAIR)
        .distinct()
        .join(state, list(PAIR), "left")
        .join(raw, list(PAIR), "left")
        .join(table, list(PAIR), "left")
        .select(
            *PAIR,
            F.coalesce("completed", no).alias("logical_completion"),
            F.coalesce("raw_found", no).alias("valid_raw"),
            F.coalesce("table_found", no).alias("table_present"),
            "latest_status",
            "latest_stage",
        )
    )


def recovery_action() -> Column:
    raw, table = F.col("valid_raw"), F.col("table_present")
    return (
        F.when(F.col("logical_completion"), "skip")
        .when(~raw & ~table, "ingest_and_load")
        .when(raw & ~table, "load_only")
        .when(raw & table, "reconcile")
        .otherwise("manual_review")
    )


def plan(evidence_rows: DataFrame) -> DataFrame:
    """The action of every pair with its reason; the latest attempt is never consulted."""
    reason = F.lit(None).cast("string")
    for action, text in REASONS.items():
        reason = F.when(F.col("action") == action, text).otherwise(reason)
    return evidence_rows.withColumn("action", recovery_action()).withColumn("reason", reason)


def plan_checks(plan_rows: DataFrame) -> DataFrame:
    """Plans (keyed by ``plan_date``) with duplicate sources or items of another date.

    An empty plan is legal and yields nothing.
    """
    per_source = plan_rows.groupBy("plan_date", "source_object").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("delivery_date").eqNullSafe(F.col("plan_date"))).alias("n_other"),
    )
    repeated = F.when(F.col("n") > 1, F.col("source_object"))
    per_plan = per_source.groupBy("plan_date").agg(
        F.array_join(F.array_sort(F.collect_list(repeated)), ",").alias("duplicate_sources"),
        F.sum("n_other").alias("n_mixed_dates"),
    )
    return per_plan.filter((F.col("duplicate_sources") != "") | (F.col("n_mixed_dates") > 0))


def plan_summary(plan_rows: DataFrame) -> DataFrame:
    """Sources per day by what they need."""
    action = F.col("action")
    return plan_rows.groupBy("delivery_date").agg(
        F.count_if(action.isin("ingest_and_load", "load_only")).alias("needs_execution"),
        F.count_if(action == "reconcile").alias("requires_reconciliation"),
        F.count_if(action == "manual_review").alias("requires_manual_review"),
        F.count_if(action == "skip").alias("skipped"),
    )


def request_checks(plan_rows: DataFrame, artifacts: DataFrame) -> DataFrame:
    """What is wrong with a request before any side effect.

    ``artifacts`` carries ``delivery_date`` (the plan it was supplied for),
    ``source_object``, ``artifact_date`` and ``gcs_uri``.
    """
    supplied = artifacts.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_artifacts"),
        F.count_if(~F.col("artifact_date").eqNullSafe(F.col("delivery_date"))).alias("n_other_date"),
    )
    load_only = plan_rows.filter(F.col("action") == "load_only").select(
        *PAIR, F.lit(True).alias("is_load_only")
    )
    joined = supplied.join(load_only, list(PAIR), "full_outer")
    wanted = F.coalesce("is_load_only", F.lit(False))
    n = F.coalesce("n_artifacts", F.lit(0))
    problems = F.concat_ws(
        ",",
        F.when(n > 1, "duplicate_artifact"),
        F.when(F.coalesce("n_other_date", F.lit(0)) > 0, "artifact_date_mismatch"),
        F.when(wanted & (n == 0), "missing_artifact"),
        F.when(~wanted & (n > 0), "unexpected_artifact"),
    )
    return joined.select(*PAIR, problems.alias("problems")).filter(F.col("problems") != "")


def recovery_steps() -> Column:
    """Transitions per action from ``ingest_ok``, ``load_ok`` and ``confirmed``."""
    action = F.col("action")
    return (
        F.when(action == "load_only", load_steps(F.col("load_ok")))
        .when(action == "ingest_and_load", replay_steps(F.col("ingest_ok"), F.col("load_ok")))
        .when(action == "reconcile", confirm_steps(F.col("confirmed")))
    )


def recovery_events(results: DataFrame, run_id: str) -> DataFrame:
    """Events of an applied plan; skipped, reviewed and blocked sources add none."""
    return explode_steps(results, recovery_steps(), run_id)


def result_outcome() -> Column:
    """Outcome of an action from ``ingest_ok``, ``load_ok`` and ``confirmed``."""
    action = F.col("action")
    worked = F.when(F.col("load_ok"), "succeeded").otherwise("failed")
    return (
        F.when(action == "skip", "skipped")
        .when(action == "manual_review", "blocked")
        .when(action == "reconcile", F.when(F.col("confirmed"), "succeeded").otherwise("blocked"))
        .when(action == "load_only", worked)
        .when(action == "ingest_and_load", F.when(F.col("ingest_ok"), worked).otherwise("failed"))
    )


def legal_results(spark: SparkSession) -> DataFrame:
    kinds = dict.fromkeys(("action", "outcome", "ingest_status", "has_load", "reconciliation"), "string")
    return constant_table(spark, LEGAL_RESULTS, {**kinds, "has_load": "boolean"})


def result_checks(results: DataFrame) -> DataFrame:
    """Results whose combination of action, outcome and facts is not legal.

    The legal combinations are a fixed table of eleven rows, hence the broadcast.
    """
    legal = F.broadcast(legal_results(results.sparkSession))
    keys = ["action", "outcome", "ingest_status", "has_load", "reconciliation"]
    return results.join(legal, keys, "left_anti")


def outcome_summary(
    results: DataFrame, events_after: DataFrame, expected: tuple[str, ...] = DAILY_SOURCES
) -> DataFrame:
    """Counts per day, with completeness re-derived from the ledger and not from this run."""
    outcome = F.col("outcome")
    per_day = results.groupBy("delivery_date").agg(
        F.count_if(outcome == "succeeded").alias("succeeded"),
        F.count_if(outcome == "failed").alias("failed"),
        F.count_if(outcome == "skipped").alias("skipped"),
        F.count_if(outcome == "blocked").alias("blocked"),
    )
    days = results.select("delivery_date").distinct()
    complete = completeness(logical_completion(events_after), days, expected).select(
        "delivery_date", F.col("complete").alias("date_complete")
    )
    return per_day.join(complete, "delivery_date")
