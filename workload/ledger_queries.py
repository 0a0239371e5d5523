"""Replay-event ledger: attempts, completion, progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from replaykit.operators import ledger
from replaykit.operators.checks import event_rules, violations
from replaykit.operators.slicing import expected_grid

from . import bindings as b
from .catalog import query
from .sqltext import cte, sql

EVENT_COLUMNS = (
    "run_id, event_id, delivery_date, source_object, status, stage, started_at, completed_at, "
    "error_message, recorded_at"
)


def _grid(spark, sf):
    return expected_grid(b.days_of(b.replay_events(spark, sf), 1))


@query("event_history", sql(
    f"SELECT {EVENT_COLUMNS} FROM replay_events WHERE source_object IN (SELECT source_object FROM daily)",
    "replay_events", "daily"))
def event_history(spark, sf):
    return ledger.history(b.replay_events(spark, sf), _grid(spark, sf))


@query("latest_attempt", sql("""
SELECT g.delivery_date, g.source_object, run_id, event_id, status, stage, started_at, completed_at,
       error_message, recorded_at
FROM event_grid g LEFT JOIN latest_attempts l USING (delivery_date, source_object)
""", "replay_events", "event_days", "daily", "event_grid", "latest_attempts"))
def latest_attempt(spark, sf):
    return ledger.latest_attempt(b.replay_events(spark, sf), _grid(spark, sf))


@query("latest_attempt_per_source", sql(
    f"SELECT {EVENT_COLUMNS} FROM latest_attempts", "replay_events", "latest_attempts"))
def latest_attempt_per_source(spark, sf):
    return ledger.latest_attempt_per_source(b.replay_events(spark, sf))


@query("logical_completion", sql(
    f"SELECT {EVENT_COLUMNS} FROM completions", "replay_events", "completions"))
def logical_completion(spark, sf):
    return ledger.logical_completion(b.replay_events(spark, sf))


@query("regressed_sources", sql("""
SELECT l.delivery_date, l.source_object, l.status AS latest_status, l.stage AS latest_stage,
       l.recorded_at AS latest_recorded_at, l.event_id AS latest_event_id, TRUE AS completed
FROM latest_attempts l JOIN completions c USING (delivery_date, source_object)
WHERE l.status <> 'success'
""", "replay_events", "latest_attempts", "completions"))
def regressed_sources(spark, sf):
    return ledger.regressed_sources(b.replay_events(spark, sf))


def completeness_of(spark, sf):
    events = b.replay_events(spark, sf)
    return ledger.date_completeness(events, b.days_of(events, 1))


STATUS_CTES = ("replay_events", "event_days", "daily", "completions", "day_complete", "day_status")


@query("date_completeness", sql(
    "SELECT delivery_date, n_completed, n_unexpected, complete FROM day_status", *STATUS_CTES))
def date_completeness(spark, sf):
    return completeness_of(spark, sf)


@query("incomplete_summary", sql("""
SELECT g.delivery_date,
       string_agg(g.source_object || '=' || coalesce(l.status || '|' || l.stage, 'not attempted'), ', '
                  ORDER BY g.source_object) AS summary
FROM event_grid g LEFT JOIN latest_attempts l USING (delivery_date, source_object)
WHERE NOT EXISTS (SELECT 1 FROM completions c
                  WHERE c.delivery_date = g.delivery_date AND c.source_object = g.source_object)
GROUP BY 1
""", "replay_events", "event_days", "daily", "event_grid", "latest_attempts", "completions"))
def incomplete_summary(spark, sf):
    events = b.replay_events(spark, sf)
    return ledger.incomplete_summary(events, b.days_of(events, 1))


@query("range_progress", sql("""
SELECT *, CASE WHEN coalesce(bool_or(NOT complete) OVER (PARTITION BY range_id ORDER BY delivery_date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) THEN 'not_attempted'
               WHEN complete THEN 'complete' ELSE 'incomplete' END AS progress
FROM (SELECT delivery_date, complete,
             CAST(floor((delivery_date - DATE '2024-01-01') / 5) AS BIGINT) AS range_id FROM day_status)
""", *STATUS_CTES))
def range_progress(spark, sf):
    five_days = F.floor(F.datediff("delivery_date", F.lit("2024-01-01").cast("date")) / 5)
    daily = completeness_of(spark, sf).select("delivery_date", "complete", five_days.alias("range_id"))
    return ledger.range_progress(daily)


@query("run_event_counts", sql("""
SELECT run_id, count(*) AS n_events, count(DISTINCT event_id) AS n_event_ids,
       min(delivery_date) AS first_date, max(delivery_date) AS last_date
FROM replay_events GROUP BY 1
""", "replay_events"))
def run_event_counts(spark, sf):
    return ledger.run_event_counts(b.replay_events(spark, sf))


def faulty_events(spark, sf):
    """Replay events with one planted fault per residue of the event number."""
    events = b.replay_events(spark, sf)
    residue = F.col("event_id").cast("bigint") % 113
    good = {c: F.col(c) for c in events.columns}

    def plant(column, value, number):
        good[column] = F.when(residue == number, value).otherwise(good[column])

    plant("status", F.lit("success"), 1)
    plant("stage", F.lit("ingestion"), 1)
    plant("completed_at", F.col("recorded_at"), 1)
    plant("error_message", F.lit(None), 1)
    plant("status", F.lit("running"), 2)
    plant("completed_at", F.col("recorded_at"), 2)
    plant("status", F.lit("failed"), 3)
    plant("completed_at", F.lit(None), 3)
    plant("run_id", F.lit("  "), 4)
    plant("completed_at", F.col("started_at") - F.expr("interval 1 hour"), 5)
    plant("status", F.lit("done"), 6)
    plant("error_message", F.lit("\t "), 7)
    return events.select(*[v.alias(n) for n, v in good.items()])


cte("faulty_events", """
SELECT CASE WHEN r = 4 THEN '  ' ELSE run_id END AS run_id, event_id, delivery_date, source_object,
       CASE r WHEN 1 THEN 'success' WHEN 2 THEN 'running' WHEN 3 THEN 'failed' WHEN 6 THEN 'done' ELSE status END AS status,
       CASE WHEN r = 1 THEN 'ingestion' ELSE stage END AS stage, started_at,
       CASE WHEN r IN (1, 2) THEN recorded_at WHEN r = 3 THEN NULL
            WHEN r = 5 THEN started_at - INTERVAL 1 HOUR ELSE completed_at END AS completed_at,
       CASE WHEN r = 1 THEN NULL WHEN r = 7 THEN chr(9) || ' ' ELSE error_message END AS error_message, recorded_at
FROM (SELECT *, CAST(event_id AS BIGINT) % 113 AS r FROM replay_events)
""")


@query("event_row_checks", sql("""
SELECT event_id, broken_rules FROM (
  SELECT event_id, concat_ws(',',
    CASE WHEN trim(run_id) = '' THEN 'run_id_blank' END,
    CASE WHEN status NOT IN ('running', 'success', 'failed') THEN 'status_unknown' END,
    CASE WHEN completed_at < started_at THEN 'completed_before_started' END,
    CASE WHEN trim(error_message, chr(9) || ' ') = '' THEN 'error_message_blank' END,
    CASE WHEN status = 'running' AND completed_at IS NOT NULL THEN 'running_has_completed_at' END,
    CASE WHEN status = 'running' AND error_message IS NOT NULL THEN 'running_has_error' END,
    CASE WHEN status = 'success' AND stage <> 'warehouse' THEN 'success_not_warehouse' END,
    CASE WHEN status = 'success' AND completed_at IS NULL THEN 'success_without_completed_at' END,
    CASE WHEN status = 'success' AND error_message IS NOT NULL THEN 'success_has_error' END,
    CASE WHEN status = 'failed' AND completed_at IS NULL THEN 'failed_without_completed_at' END) AS broken_rules
  FROM faulty_events)
WHERE broken_rules <> ''
""", "replay_events", "faulty_events"))
def event_row_checks(spark, sf):
    return violations(faulty_events(spark, sf), event_rules(), ["event_id"])


def outcomes(spark, sf):
    """One attempt per order: whether it was ingested and loaded."""
    k = F.col("k")
    ingest_ok = k % 7 != 0
    return b.jobs(spark, sf).select(
        "k",
        "delivery_date",
        "source_object",
        ingest_ok.alias("ingest_ok"),
        (ingest_ok & (k % 5 != 0)).alias("load_ok"),
        (k % 11 == 0).alias("skipped"),
    )


cte("outcomes", """
SELECT k, delivery_date, source_object, k % 7 <> 0 AS ingest_ok, k % 7 <> 0 AND k % 5 <> 0 AS load_ok,
       k % 11 = 0 AS skipped
FROM jobs
""")


@query("warehouse_eligible", sql(
    "SELECT k, delivery_date, source_object FROM outcomes WHERE ingest_ok", "jobs", "outcomes"))
def warehouse_eligible(spark, sf):
    return ledger.warehouse_eligible(outcomes(spark, sf)).select("k", "delivery_date", "source_object")


def pair_outcomes(spark, sf):
    """Outcome per pair: good only when every attempt of the pair was."""
    return outcomes(spark, sf).groupBy("delivery_date", "source_object").agg(
        F.bool_and("ingest_ok").alias("ingest_ok"), F.bool_and("load_ok").alias("load_ok")
    )


cte("pair_outcomes", """
SELECT delivery_date, source_object, bool_and(ingest_ok) AS ingest_ok, bool_and(load_ok) AS load_ok
FROM outcomes GROUP BY 1, 2
""")


@query("events_from_outcomes", sql("""
SELECT delivery_date, source_object, step, status, stage, 'run-1' AS run_id,
       sha256('run-1|' || delivery_date || '|' || source_object || '|' || step || '|' || status || '|' || stage) AS event_id
FROM (
  SELECT delivery_date, source_object, 0 AS step, 'running' AS status, 'ingestion' AS stage FROM pair_outcomes
  UNION ALL
  SELECT delivery_date, source_object, 1, CASE WHEN ingest_ok THEN 'running' ELSE 'failed' END,
         CASE WHEN ingest_ok THEN 'warehouse' ELSE 'ingestion' END FROM pair_outcomes
  UNION ALL
  SELECT delivery_date, source_object, 2, CASE WHEN load_ok THEN 'success' ELSE 'failed' END, 'warehouse'
  FROM pair_outcomes WHERE ingest_ok)
""", "jobs", "outcomes", "pair_outcomes"))
def events_from_outcomes(spark, sf):
    return ledger.events_from_outcomes(pair_outcomes(spark, sf), "run-1").drop("ingest_ok", "load_ok")
