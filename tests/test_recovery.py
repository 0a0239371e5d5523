"""Decisions, legal results, reconciliation of every reason, run roll-ups."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators import recovery, runs
from replaykit.operators.reconciliation import display_reason, reconcile

from .conftest import rows

DAY, NEXT = dt.date(2021, 3, 8), dt.date(2021, 3, 9)
AT = dt.datetime(2021, 4, 2, 8, 30)
PAIR = "delivery_date date, source_object string"


@pytest.mark.parametrize(
    ("done", "raw", "table", "action"),
    [
        (True, True, True, "skip"), (True, False, False, "skip"), (False, False, False, "ingest_and_load"),
        (False, True, False, "load_only"), (False, True, True, "reconcile"), (False, False, True, "manual_review"),
    ],
)
def test_decision_table(spark, done, raw, table, action):
    evidence = spark.createDataFrame(
        [(DAY, "orders", done, raw, table)],
        f"{PAIR}, logical_completion boolean, valid_raw boolean, table_present boolean",
    )
    row = recovery.plan(evidence).first()
    assert (row.action, row.reason) == (action, recovery.REASONS[action])


LOAD = {
    "load_id": "l1", "provenance_id": "p1", "run_id": "r1", "delivery_date": DAY, "source_object": "orders",
    "destination": "db.raw.orders$20210308", "partition_date": DAY, "output_rows": 5, "job_id": "j1", "recorded_at": AT,
}
ARTIFACT = {
    "provenance_id": "p1", "run_id": "r1", "delivery_date": DAY, "source_object": "orders", "ingestion_date": NEXT,
    "gcs_uri": "store://depot/in/orders/ingestion_date=2021-03-09/orders.csv", "checksum": "5e1f",
    "file_size_bytes": 100, "record_count": 5, "recorded_at": AT,
}
SEEN = {"gcs_uri": ARTIFACT["gcs_uri"], "present": True, "checksum": "5e1f", "file_size_bytes": 100}
TABLE = {
    "source_object": "orders", "partition_date": DAY, "destination": "db.raw.orders$20210308", "present": True,
    "row_count": 5,
}
TYPES = {str: "string", int: "bigint", bool: "boolean", dt.date: "date", dt.datetime: "timestamp"}


def frame(spark, template, *changed):
    schema = ", ".join(f"{k} {TYPES[type(v)]}" for k, v in template.items())
    return spark.createDataFrame([tuple({**template, **c}.values()) for c in changed], schema)


OTHER_URI = "store://depot/in/orders/xingestion_date=2021-03-09/orders.csv"


@pytest.mark.parametrize(
    ("load", "artifact", "seen", "table", "reason"),
    [
        ({}, {}, {}, {}, "confirmed"),
        ({"output_rows": 0}, {"record_count": 0}, {}, {"row_count": 0}, "confirmed"),
        (None, {}, {}, {}, "no_warehouse_load_provenance"),
        ({}, None, {}, {}, "no_artifact_provenance"),
        ({"provenance_id": "other"}, {}, {}, {}, "no_artifact_provenance"),
        ({"partition_date": NEXT}, {}, {}, {}, "provenance_identity_mismatch"),
        ({}, {"delivery_date": NEXT}, {}, {}, "provenance_identity_mismatch"),
        ({}, {"source_object": "reviews"}, {}, {}, "provenance_identity_mismatch"),
        ({}, {}, {"present": False, "checksum": None, "file_size_bytes": None}, {}, "gcs_artifact_missing"),
        ({}, {}, None, {}, "gcs_artifact_missing"),
        ({}, {}, {"checksum": None}, {}, "gcs_checksum_missing"),
        ({}, {}, {"checksum": "x"}, {}, "gcs_checksum_mismatch"),
        ({}, {}, {"file_size_bytes": 101}, {}, "gcs_size_mismatch"),
        ({}, {}, {"file_size_bytes": None}, {}, "gcs_size_mismatch"),
        ({}, {"ingestion_date": DAY}, {}, {}, "gcs_ingestion_date_mismatch"),
        ({}, {"gcs_uri": OTHER_URI}, {"gcs_uri": OTHER_URI}, {}, "gcs_ingestion_date_mismatch"),
        ({}, {}, {}, {"present": False, "row_count": None}, "bigquery_partition_missing"),
        ({}, {}, {}, None, "bigquery_partition_missing"),
        ({}, {}, {}, {"destination": "db.raw.orders$20210309"}, "bigquery_destination_mismatch"),
        ({}, {}, {}, {"row_count": 6}, "bigquery_row_count_mismatch"),
        ({}, {"record_count": 6}, {}, {}, "bigquery_row_count_mismatch"),
        ({}, {}, {}, {"row_count": None}, "bigquery_row_count_mismatch"),
    ],
)
def test_every_reason(spark, load, artifact, seen, table, reason):
    def some(template, change):
        return frame(spark, template, *([] if change is None else [change]))

    pairs = spark.createDataFrame([(DAY, "orders")], PAIR)
    row = reconcile(pairs, some(LOAD, load), some(ARTIFACT, artifact), some(SEEN, seen), some(TABLE, table)).first()
    assert row.reason == reason
    if reason == "confirmed":
        assert (row.outcome, row.provenance_id, row.load_id) == ("confirmed", "p1", "l1")
    else:
        assert (row.outcome, row.provenance_id, row.load_id) == ("blocked", None, None)


def test_only_the_latest_load_counts(spark):
    older = {"load_id": "l0", "output_rows": 99, "recorded_at": AT - dt.timedelta(days=1)}
    pairs = spark.createDataFrame([(DAY, "orders")], PAIR)
    row = reconcile(
        pairs, frame(spark, LOAD, {}, older), frame(spark, ARTIFACT, {}), frame(spark, SEEN, {}), frame(spark, TABLE, {})
    ).first()
    assert (row.reason, row.load_id) == ("confirmed", "l1")


def test_display_reasons(spark):
    df = spark.createDataFrame([("gcs_size_mismatch",), ("confirmed",)], "r string")
    assert rows(df.select(display_reason(F.col("r")))) == [("confirmed",), ("raw_size_mismatch",)]


def test_request_checks(spark):
    plan = spark.createDataFrame(
        [(DAY, "orders", "load_only"), (DAY, "payments", "load_only"), (DAY, "reviews", "skip")], f"{PAIR}, action string"
    )
    supplied = spark.createDataFrame(
        [(DAY, "orders", DAY, "gs://b/1"), (DAY, "orders", NEXT, "gs://b/2"), (DAY, "reviews", DAY, "gs://b/3")],
        f"{PAIR}, artifact_date date, gcs_uri string",
    )
    assert rows(recovery.request_checks(plan, supplied), "source_object", "problems") == [
        ("orders", "duplicate_artifact,artifact_date_mismatch"),
        ("payments", "missing_artifact"),
        ("reviews", "unexpected_artifact"),
    ]


def test_recovery_steps_and_outcomes(spark):
    results = spark.createDataFrame(
        [
            (DAY, "a", "skip", False, False, False), (DAY, "b", "manual_review", False, False, False),
            (DAY, "c", "reconcile", False, False, True), (DAY, "d", "reconcile", False, False, False),
            (DAY, "e", "load_only", False, True, False), (DAY, "f", "load_only", False, False, False),
            (DAY, "g", "ingest_and_load", True, True, False), (DAY, "h", "ingest_and_load", False, False, False),
            (DAY, "i", "ingest_and_load", True, False, False),
        ],
        f"{PAIR}, action string, ingest_ok boolean, load_ok boolean, confirmed boolean",
    )
    steps = {}
    for row in recovery.recovery_events(results, "r").orderBy("step").collect():
        steps.setdefault(row.source_object, []).append(f"{row.status}|{row.stage}")
    assert steps == {
        "c": ["success|warehouse"],
        "e": ["running|warehouse", "success|warehouse"],
        "f": ["running|warehouse", "failed|warehouse"],
        "g": ["running|ingestion", "running|warehouse", "success|warehouse"],
        "h": ["running|ingestion", "failed|ingestion"],
        "i": ["running|ingestion", "running|warehouse", "failed|warehouse"],
    }
    outcomes = rows(results.select("source_object", recovery.result_outcome()))
    assert [o for _, o in outcomes] == [
        "skipped", "blocked", "succeeded", "blocked", "succeeded", "failed", "succeeded", "failed", "failed",
    ]


def test_illegal_results(spark):
    results = spark.createDataFrame(
        [("skip", "skipped", "none", False, "none"), ("skip", "succeeded", "none", False, "none"),
         ("load_only", "succeeded", "none", False, "none"), ("reconcile", "succeeded", "none", False, "blocked"),
         ("ingest_and_load", "failed", "success", False, "none"), ("ingest_and_load", "succeeded", "failed", True, "none")],
        "action string, outcome string, ingest_status string, has_load boolean, reconciliation string",
    )
    assert rows(recovery.result_checks(results), "action", "outcome") == [
        ("ingest_and_load", "succeeded"), ("load_only", "succeeded"), ("reconcile", "succeeded"), ("skip", "succeeded"),
    ]


def test_batch_status(spark):
    made = [("a", "success"), ("a", "skipped"), ("b", "success"), ("b", "failed"), ("c", "failed"), ("c", "failed")]
    got = runs.batch_status(spark.createDataFrame(made, "batch string, status string"), "batch")
    assert rows(got) == [
        ("a", 1, 0, 1, 2, "success", 0), ("b", 1, 1, 0, 2, "partial_failure", 1), ("c", 0, 2, 0, 2, "failed", 2),
    ]
