"""Attempts, completion and progress over a small ledger."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators import ledger
from replaykit.operators.checks import enforce, event_rules, violations

from .conftest import rows

D1, D2, D3 = (dt.date(2017, 5, n) for n in (1, 2, 3))
SCHEMA = (
    "run_id string, event_id string, delivery_date date, source_object string, status string, stage string, "
    "started_at timestamp, completed_at timestamp, error_message string, recorded_at timestamp"
)


def event(number, day, source, status, stage="warehouse", minute=None):
    start = dt.datetime(2017, 6, 1, 10, 0)
    at = start + dt.timedelta(minutes=number if minute is None else minute)
    done = None if status == "running" else at
    error = "category=x" if status == "failed" else None
    return ("run-1", f"e{number:03d}", day, source, status, stage, start, done, error, at)


@pytest.fixture(scope="module")
def events(spark):
    made = [
        event(1, D1, "orders", "success"), event(2, D1, "orders", "failed"),
        event(3, D1, "order_items", "success"), event(4, D1, "payments", "success"), event(5, D1, "reviews", "success"),
        event(6, D2, "orders", "running", "ingestion"), event(7, D2, "orders", "failed", "ingestion"),
        event(8, D2, "payments", "success"), event(9, D2, "payments", "running", minute=8),
        event(10, D3, "extra", "success"),
    ]
    return spark.createDataFrame(made, SCHEMA)


def calendar(spark):
    return spark.createDataFrame([(D1,), (D2,), (D3,)], "delivery_date date")


def test_completion_survives_a_later_failure(events):
    completed = rows(ledger.logical_completion(events), "delivery_date", "source_object", "event_id")
    assert (D1, "orders", "e001") in completed
    latest = rows(ledger.latest_attempt_per_source(events), "source_object", "delivery_date", "status")
    assert ("orders", D1, "failed") in latest
    assert rows(ledger.regressed_sources(events), "source_object") == [("orders",), ("payments",)]


def test_tie_goes_to_the_greater_event_id(events):
    latest = ledger.latest_attempt_per_source(events).filter("source_object = 'payments' and day(delivery_date) = 2")
    assert latest.first().event_id == "e009"


def test_order_of_input_rows_is_irrelevant(events):
    shuffled = events.orderBy(F.desc("event_id")).repartition(7)
    for question in (ledger.logical_completion, ledger.latest_attempt_per_source, ledger.pair_state):
        assert rows(question(shuffled)) == rows(question(events.coalesce(1)))


def test_date_completeness(spark, events):
    got = rows(ledger.date_completeness(events, calendar(spark)))
    assert got == [(D1, 4, 0, True), (D2, 1, 0, False), (D3, 0, 1, False)]


def test_extra_completed_source_spoils_a_date(spark, events):
    more = events.unionByName(spark.createDataFrame([event(11, D1, "extra", "success")], SCHEMA))
    assert rows(ledger.date_completeness(more, calendar(spark)))[0] == (D1, 4, 1, False)


def test_malformed_completion_input_fails(spark, events):
    completed = ledger.logical_completion(events)
    with pytest.raises(Exception, match="duplicate completion"):
        ledger.completeness(completed.unionByName(completed), calendar(spark)).collect()
    with pytest.raises(ValueError):
        ledger.completeness(completed, calendar(spark), ())


def test_incomplete_summary(spark, events):
    got = dict(rows(ledger.incomplete_summary(events, calendar(spark))))
    assert got == {
        D2: "order_items=not attempted, orders=failed|ingestion, reviews=not attempted",
        D3: "order_items=not attempted, orders=not attempted, payments=not attempted, reviews=not attempted",
    }


def test_range_stops_after_first_incomplete(spark):
    daily = spark.createDataFrame(
        [(0, D1, True), (0, D2, False), (0, D3, True), (1, D1, True), (1, D2, True)],
        "range_id int, delivery_date date, complete boolean",
    )
    got = rows(ledger.range_progress(daily), "range_id", "delivery_date", "progress")
    assert got == [
        (0, D1, "complete"), (0, D2, "incomplete"), (0, D3, "not_attempted"), (1, D1, "complete"), (1, D2, "complete"),
    ]


def test_event_sequences(spark):
    outcomes = spark.createDataFrame(
        [(D1, "orders", True, True), (D1, "payments", False, False), (D1, "reviews", True, False)],
        "delivery_date date, source_object string, ingest_ok boolean, load_ok boolean",
    )
    made = ledger.events_from_outcomes(outcomes, "run-9").orderBy("step").collect()
    steps = {}
    for row in made:
        steps.setdefault(row.source_object, []).append(f"{row.status}|{row.stage}")
    assert steps == {
        "orders": ["running|ingestion", "running|warehouse", "success|warehouse"],
        "payments": ["running|ingestion", "failed|ingestion"],
        "reviews": ["running|ingestion", "running|warehouse", "failed|warehouse"],
    }
    again = ledger.events_from_outcomes(outcomes.repartition(3), "run-9")
    assert rows(again, "event_id") == sorted((r.event_id,) for r in made)
    assert len({r.event_id for r in made}) == len(made)


def test_history_and_latest_of_requested_pairs(spark, events):
    pairs = spark.createDataFrame([(D2, "payments"), (D3, "orders")], "delivery_date date, source_object string")
    history = [r.event_id for r in ledger.history(events, pairs).collect()]
    assert history == ["e008", "e009"]
    latest = rows(ledger.latest_attempt(events, pairs), "source_object", "event_id")
    assert latest == [("orders", None), ("payments", "e009")]


def test_event_rules(spark, events):
    assert violations(events, event_rules(), ["event_id"]).count() == 0
    bad = list(event(50, D1, "orders", "success", "ingestion"))
    bad[0], bad[8] = " ", "x"
    broken = spark.createDataFrame([tuple(bad)], SCHEMA)
    assert violations(broken, event_rules(), ["event_id"]).first().broken_rules == (
        "run_id_blank,success_not_warehouse,success_has_error"
    )
    assert enforce(events, event_rules()).count() == events.count()
    with pytest.raises(Exception, match="run_id_blank"):
        enforce(broken, event_rules()).collect()


def test_newest_is_pruned_before_the_shuffle(events):
    plan = ledger.logical_completion(events)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "Python" not in plan
