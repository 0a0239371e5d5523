"""Ingestion of delivered files: stored claims and run rows over several runs, and replays that start from files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators.checks import run_rules, violations
from replaykit.operators.runs import run_json
from replaykit.plans.ingest import deliveries_of, ingest
from replaykit.plans.replay import refusals, replay_files
from replaykit.sources.registry import DAILY_SOURCES, columns_of

from .conftest import rows

CLOCK = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
def landing():
    return F.date_add("delivery_date", 1)



def put(root, source, day, name="part.csv", lines=1, columns=None):
    folder = root / source / f"delivery_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    names = columns or columns_of(source)
    body = "".join(",".join(f"{source}-{day}-{n}-{i}" for i in range(len(names))) + "\n" for n in range(lines))
    (folder / name).write_text(",".join(names) + "\n" + body)


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "delivered"
    for source in DAILY_SOURCES:
        for day in ("2017-05-01", "2017-05-02"):
            put(folder, source, day, lines=0 if source == "reviews" else 2)
    return folder


def days(spark, *listed):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in listed], "delivery_date date")


def test_claims_and_run_rows_are_stored(spark, database, root):
    put(root, "payments", "2017-05-03", columns=columns_of("payments")[:-1])
    first = ingest(spark, database, str(root), landing(), "run-1", lambda: CLOCK)
    assert sorted(r.status for r in first.collect()) == ["failed"] + ["success"] * 8
    again = ingest(spark, database, str(root), landing(), "run-1", lambda: CLOCK)  # as after a crash: its own claims are no conflict
    assert sorted(r.status for r in again.collect()) == ["failed"] + ["success"] * 8
    runs, manifest = spark.table(f"{database}.ingestion_runs"), spark.table(f"{database}.landing_manifest")
    assert runs.count() == 9 and manifest.count() == 8
    later = CLOCK + dt.timedelta(days=1)
    other = ingest(spark, database, str(root), landing(), "run-2", lambda: later)
    assert {r.status for r in other.collect()} == {"failed"}
    taken = [r.error_message for r in other.filter("valid").collect()]
    assert len(taken) == 8 and all("storage_write_failed" in m for m in taken)
    assert manifest.count() == 8 and spark.table(f"{database}.ingestion_runs").count() == 18
    assert violations(spark.table(f"{database}.ingestion_runs"), run_rules(), ["ingestion_id"]).count() == 0
    assert run_json(spark.table(f"{database}.ingestion_runs")).where("json LIKE '%\"status\":\"success\"%'").count() == 8
    assert "PartitionFilters: [isnotnull(ingestion_date" in manifest.where("ingestion_date = DATE'2017-05-02'")._jdf.queryExecution().executedPlan().toString()


def test_two_files_of_one_delivery_are_ambiguous(spark, database, root):
    put(root, "orders", "2017-05-02", name="second.csv")
    pairs = deliveries_of(ingest(spark, database, str(root), landing(), "run-1", lambda: CLOCK), "gs://b/")
    got = {(r.source_object, r.delivery_date.day): (r.status, r.gcs_uri, r.record_count) for r in pairs.collect()}
    assert got[("orders", 2)] == ("failed", None, None)
    assert got[("orders", 1)] == ("success", "gs://b/raw/order_platform/orders/ingestion_date=2017-05-02/part.csv", 2)


def test_replay_of_files_stops_and_lands_no_later_file(spark, database, root):
    put(root, "orders", "2017-05-02", columns=columns_of("orders")[:-1])
    for source in DAILY_SOURCES:
        put(root, source, "2017-05-03")
    wanted = days(spark, "2017-05-01", "2017-05-02", "2017-05-03")
    done = replay_files(spark, database, str(root), wanted, landing(), "gs://b", "run-1", lambda: CLOCK)
    assert {r.delivery_date.day: r.progress for r in done.collect()} == {1: "complete", 2: "incomplete", 3: "not_attempted"}
    assert rows(spark.table(f"{database}.landing_manifest").groupBy("delivery_date").count().select("count")) == [(3,), (4,)]
    assert spark.table(f"{database}.orders").count() == 2 and spark.table(f"{database}.payments").count() == 4
    put(root, "orders", "2017-05-02", lines=3)
    later = CLOCK + dt.timedelta(hours=1)
    done = replay_files(spark, database, str(root), wanted, landing(), "gs://b", "run-1", lambda: later)
    assert {r.progress for r in done.collect()} == {"complete"}
    assert spark.table(f"{database}.orders").count() == 6 and spark.table(f"{database}.landing_manifest").count() == 12


def test_refused_batches_are_named(spark):
    given = [("2017-05-01", s) for s in DAILY_SOURCES] + [("2017-05-02", "orders"), ("2017-05-02", "returns")]
    deliveries = spark.createDataFrame([(dt.date.fromisoformat(d), s) for d, s in given], "delivery_date date, source_object string")
    assert rows(refusals(days(spark, "2017-05-01", "2017-05-02"), deliveries)) == [
        (dt.date(2017, 5, 2), "order_items,payments,reviews", "returns"),
    ]
