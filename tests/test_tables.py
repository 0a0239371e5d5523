"""Sinks and whole jobs: idempotent replaces, append-once ledgers, replay and recovery."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replaykit.operators import ledger, recovery
from replaykit.operators.checks import artifact_rules, event_rules, load_rules, violations
from replaykit.plans.apply import apply_plan, recovery_summary
from replaykit.plans.initial import initial_load
from replaykit.plans.replay import range_status, replay_range
from replaykit.session import written_table
from replaykit.sources import tables
from replaykit.sources.registry import DAILY_SOURCES, MASTER_SOURCES, columns_of
from workload import table_queries

from .conftest import rows

DAY = {n: dt.date(2017, 5, n) for n in range(1, 6)}
CLOCK = dt.datetime(2017, 6, 1, tzinfo=dt.timezone.utc)


def raw(spark, source, *keys_and_days):
    names = columns_of(source)
    data = [(key, *[""] * (len(names) - 1), day) for key, day in keys_and_days]
    schema = ", ".join(f"{n} string" for n in names) + ", delivery_date date"
    return spark.createDataFrame(data, schema)


def day_frame(spark, *numbers):
    return spark.createDataFrame([(DAY[n],) for n in numbers], "delivery_date date")


def counts(spark, database, source="orders"):
    listed = tables.registered_partitions(spark, database, source)
    counted = tables.partition_counts(spark, database, source)
    joined = listed.join(counted, ["source_object", "partition_date"], "left")
    return {r.partition_date.day: r.n or 0 for r in joined.collect()}


def test_partition_replace(spark, database):
    first = raw(spark, "orders", ("a", DAY[1]), ("b", DAY[1]), ("c", DAY[2]), ("d", DAY[3]))
    tables.replace_partitions(first, database, "orders", day_frame(spark, 1, 2, 3))
    assert counts(spark, database) == {1: 2, 2: 1, 3: 1}
    # Day 1 changes, day 2 becomes empty, day 4 is empty from the start, day 5 is not asked for.
    replay = raw(spark, "orders", ("x", DAY[1]), ("y", DAY[5]))
    for _ in range(2):
        tables.replace_partitions(replay, database, "orders", day_frame(spark, 1, 2, 4))
        assert counts(spark, database) == {1: 1, 2: 0, 3: 1, 4: 0}
    assert rows(spark.table(f"{database}.orders"), "order_id") == [("d",), ("x",)]
    tables.replace_partitions(replay.limit(0), database, "orders", day_frame(spark, 1))
    assert counts(spark, database) == {1: 0, 2: 0, 3: 1, 4: 0}


def test_a_hot_day_is_split_over_tasks(spark, database):
    """A day with most rows is written by several tasks, not gathered into one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(60_000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
            *[F.lit("").alias(c) for c in columns_of("orders")[1:]],
            F.when(F.col("id") % 10 == 0, F.lit(DAY[2])).otherwise(F.lit(DAY[1])).alias("delivery_date"),
        )
        tables.replace_partitions(hot.repartition(8), database, "orders", day_frame(spark, 1, 2))
        files = spark.table(f"{database}.orders").filter(F.col("delivery_date") == F.lit(DAY[1]))
        assert files.select(F.input_file_name()).distinct().count() > 3
        assert counts(spark, database) == {1: 54_000, 2: 6_000}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def events_of(spark, *ids):
    at = dt.datetime(2017, 6, 1, 10)
    data = [("r", i, DAY[n], "orders", "running", "ingestion", at, None, None, at) for i, n in ids]
    return spark.createDataFrame(data, tables.LEDGERS["replay_events"][1])


def test_append_is_idempotent_and_prunes(spark, database):
    tables.append_ledger(events_of(spark, ("a", 1), ("a", 1), ("b", 2)), database, "replay_events")
    tables.append_ledger(events_of(spark, ("a", 1), ("c", 2)), database, "replay_events")
    tables.append_ledger(events_of(spark), database, "replay_events")
    stored = spark.table(f"{database}.replay_events")
    assert rows(stored, "event_id", "delivery_date") == [("a", DAY[1]), ("b", DAY[2]), ("c", DAY[2])]
    one_day = stored.filter(F.col("delivery_date") == F.lit(DAY[1]))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery_date" in plan


def test_an_id_that_is_known_stays_out_whatever_its_day(spark, database):
    tables.append_ledger(events_of(spark, ("a", 1)), database, "replay_events")
    for _ in range(2):
        tables.append_ledger(events_of(spark, ("a", 2), ("b", 1), ("c", 1), ("c", 2)), database, "replay_events")
    assert rows(spark.table(f"{database}.replay_events"), "event_id")[:2] == [("a",), ("b",)]
    assert spark.table(f"{database}.replay_events").count() == 3


def test_a_retried_append_moves_ids_only(spark, database, monkeypatch):
    sent = events_of(spark, ("a", 1), ("b", 2))
    tables.append_ledger(sent, database, "replay_events")

    def moved(*_):
        raise AssertionError("rows of a retried append are brought together")

    monkeypatch.setattr(type(sent), "dropDuplicates", moved)
    tables.append_ledger(sent, database, "replay_events")
    assert spark.table(f"{database}.replay_events").count() == 2


def test_children_are_sliced_once_for_all_loads(spark, monkeypatch):
    plans, replace = [], tables.replace_partitions

    def seen(loaded, database, source, days):
        plans.extend(x._jdf.queryExecution().optimizedPlan().toString() for x in (loaded, days))
        return replace(loaded, database, source, days)

    monkeypatch.setattr(tables, "replace_partitions", seen)
    table_queries.replaced_days(spark, "/root/testdata/sf0.001")
    assert len(plans) == 24 and not any("Join" in plan for plan in plans)


def masters(spark):
    return {s: raw(spark, s, ("1", None), ("2", None)).drop("delivery_date") for s in MASTER_SOURCES}


def test_initial_load_is_all_or_nothing(spark, database):
    data = masters(spark)
    good = [(s, "success") for s in MASTER_SOURCES]
    schema = "source_object string, status string"
    for bad in (good[1:], [*good, ("orders", "success")], [("customers", "failed"), *good[1:]]):
        with pytest.raises(ValueError, match="refused"):
            initial_load(spark, database, spark.createDataFrame(bad, schema), data.__getitem__)
    assert not any(spark.catalog.tableExists(f"{database}.{s}") for s in MASTER_SOURCES)
    for _ in range(2):
        names = initial_load(spark, database, spark.createDataFrame(good, schema), data.__getitem__)
    assert {s: spark.table(t).count() for s, t in names.items()} == {s: 2 for s in MASTER_SOURCES}


def outcomes_of(spark, numbers, bad=()):
    data = []
    for n in numbers:
        for source in DAILY_SOURCES:
            status = "failed" if (n, source) in bad else "success"
            n_rows = 0 if source == "reviews" else 1
            data.append((
                DAY[n], source, status, "category=x" if status == "failed" else None, DAY[n] + dt.timedelta(days=1),
                f"gs://b/raw/{source}/ingestion_date={DAY[n] + dt.timedelta(days=1)}/{source}.csv", "abc", 10, n_rows,
            ))
    return spark.createDataFrame(
        data,
        "delivery_date date, source_object string, status string, error_message string, ingestion_date date, "
        "gcs_uri string, checksum string, file_size_bytes bigint, record_count bigint",
    )


def rows_of(spark):
    def get(source):
        if source == "reviews":
            return raw(spark, source, ("z", DAY[5])).limit(0)
        return raw(spark, source, *[(f"{source}-{n}", day) for n, day in DAY.items()])

    return get


def progress(df):
    return {r.delivery_date.day: r.progress for r in df.collect()}


def assert_ledgers_legal(spark, database):
    checks = {"replay_events": event_rules(), "artifact_provenance": artifact_rules(), "load_provenance": load_rules()}
    for name, rules in checks.items():
        table = spark.table(f"{database}.{name}")
        assert violations(table, rules, table.columns[:1]).count() == 0


def test_three_day_replay(spark, database):
    days, outcomes = day_frame(spark, 1, 2, 3), outcomes_of(spark, (1, 2, 3))
    done = replay_range(spark, database, days, outcomes, outcomes, rows_of(spark), "run-1", lambda: CLOCK)
    assert progress(done) == {1: "complete", 2: "complete", 3: "complete"}
    events = spark.table(f"{database}.replay_events")
    assert rows(ledger.run_event_counts(events)) == [("run-1", 36, 36, DAY[1], DAY[3])]
    assert_ledgers_legal(spark, database)
    loads = spark.table(f"{database}.load_provenance")
    assert loads.count() == 12 and spark.table(f"{database}.artifact_provenance").count() == 12
    zero = loads.filter("source_object = 'reviews'")
    assert rows(zero, "output_rows") == [(0,)] * 3
    assert counts(spark, database, "reviews") == {1: 0, 2: 0, 3: 0}
    assert counts(spark, database, "orders") == {1: 1, 2: 1, 3: 1}


def test_a_run_retried_under_its_id_completes(spark, database):
    days, outcomes = day_frame(spark, 1), outcomes_of(spark, (1,))
    good = rows_of(spark)

    def broken(source):
        frame = good(source)
        return frame.withColumn("order_id", F.raise_error(F.lit("no disk")).cast("string")) if source == "payments" else frame

    done = replay_range(spark, database, days, outcomes, outcomes, broken, "run-1", lambda: CLOCK)
    assert progress(done) == {1: "incomplete"}
    again = CLOCK + dt.timedelta(hours=1)
    done = replay_range(spark, database, days, outcomes, outcomes, good, "run-1", lambda: again)
    assert progress(done) == {1: "complete"}
    assert_ledgers_legal(spark, database)
    events = spark.table(f"{database}.replay_events")
    before = events.count()
    tables.append_ledger(written_table(events, "again"), database, "replay_events")
    assert spark.table(f"{database}.replay_events").count() == before


def test_a_bad_day_of_one_source_fails_alone(spark, database):
    """One day's rows cannot be written; its siblings, and the other days of its source, are published."""
    days, outcomes, good = day_frame(spark, 1, 2, 3), outcomes_of(spark, (1, 2, 3)), rows_of(spark)

    def broken(source):
        frame = good(source)
        bad = F.when(F.col("delivery_date") == F.lit(DAY[2]), F.raise_error(F.lit("torn")).cast("string"))
        return frame.withColumn("order_id", bad.otherwise(F.col("order_id"))) if source == "payments" else frame

    done = replay_range(spark, database, days, outcomes, outcomes, broken, "run-1", lambda: CLOCK)
    assert progress(done) == {1: "complete", 2: "incomplete", 3: "not_attempted"}  # the range status stops at day 2
    last = {(r.delivery_date.day, r.source_object): r.status for r in ledger.latest_attempt_per_source(spark.table(f"{database}.replay_events")).collect()}
    assert [k for k, status in last.items() if status == "failed"] == [(2, "payments")] and len(last) == 12
    assert counts(spark, database, "payments") == {1: 1, 3: 1}
    assert spark.table(f"{database}.load_provenance").count() == 11
    assert_ledgers_legal(spark, database)


def test_a_ledger_of_many_days_is_read_for_the_requested_ones(spark, database):
    from replaykit.plans.replay import ledger_of

    outcomes = outcomes_of(spark, (1, 2, 3))
    replay_range(spark, database, day_frame(spark, 1, 2, 3), outcomes, outcomes, rows_of(spark), "run-1", lambda: CLOCK)
    some = ledger_of(spark, f"{database}.replay_events", day_frame(spark, 2))
    assert rows(some.select("delivery_date").distinct()) == [(DAY[2],)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery_date" in plan and "2017-05-02" in plan or "17288" in plan


def test_replay_stops_and_recovery_completes(spark, database):
    days = day_frame(spark, 1, 2, 3)
    outcomes = outcomes_of(spark, (1, 2, 3), bad={(2, "payments")})
    get = rows_of(spark)
    done = replay_range(spark, database, days, outcomes, outcomes, get, "run-1", lambda: CLOCK)
    assert progress(done) == {1: "complete", 2: "incomplete", 3: "not_attempted"}
    events = spark.table(f"{database}.replay_events")
    history = ledger.history(events, spark.createDataFrame([(DAY[2], "payments")], "delivery_date date, source_object string"))
    assert [(r.status, r.stage, r.error_message) for r in history.collect()] == [
        ("running", "ingestion", None), ("failed", "ingestion", "category=x"),
    ]
    # Recovery: day 2 payments ingested anew, day 3 orders reuse a landed artifact.
    pair = "delivery_date date, source_object string"
    plan = spark.createDataFrame(
        [(DAY[2], "orders", "skip"), (DAY[2], "payments", "ingest_and_load"), (DAY[1], "orders", "load_only"),
         (DAY[3], "orders", "load_only"), (DAY[3], "reviews", "reconcile"), (DAY[3], "payments", "manual_review")],
        f"{pair}, action string",
    )
    uri = "gs://b/raw/orders/ingestion_date={}/orders.csv"
    supplied = spark.createDataFrame(
        [(DAY[n], "orders", DAY[n], uri.format(DAY[n] + dt.timedelta(days=1))) for n in (1, 3)],
        f"{pair}, artifact_date date, gcs_uri string",
    )
    mended = outcomes_of(spark, (2,))
    verdicts = spark.createDataFrame([(DAY[3], "reviews", "confirmed")], f"{pair}, outcome string")
    results = apply_plan(
        spark, database, plan, supplied, mended, mended, verdicts, get, "fix-1", lambda: CLOCK + dt.timedelta(days=1)
    )
    got = {(r.delivery_date.day, r.source_object): r.outcome for r in results.collect()}
    assert got == {
        (2, "orders"): "skipped", (2, "payments"): "succeeded", (1, "orders"): "succeeded",
        (3, "orders"): "failed", (3, "reviews"): "succeeded", (3, "payments"): "blocked",
    }
    assert recovery.result_checks(results).count() == 0
    assert_ledgers_legal(spark, database)
    events = spark.table(f"{database}.replay_events")
    fixed = events.filter("run_id = 'fix-1'").orderBy("recorded_at", "event_id").collect()
    steps = {}
    for row in fixed:
        steps.setdefault((row.delivery_date.day, row.source_object), []).append(f"{row.status}|{row.stage}")
    assert steps == {
        (1, "orders"): ["running|warehouse", "success|warehouse"],
        (2, "payments"): ["running|ingestion", "running|warehouse", "success|warehouse"],
        (3, "orders"): ["running|warehouse", "failed|warehouse"],
        (3, "reviews"): ["success|warehouse"],
    }
    unknown = [r.error_message for r in fixed if r.status == "failed"]
    assert "No durable Raw artifact provenance" in unknown[0]
    summary = {r.delivery_date.day: r.date_complete for r in recovery_summary(spark, database, results).collect()}
    assert summary == {1: True, 2: True, 3: False}
    assert progress(range_status(events, days)) == {1: "complete", 2: "complete", 3: "incomplete"}


def test_malformed_request_has_no_effect(spark, database):
    pair = "delivery_date date, source_object string"
    none = spark.createDataFrame([], f"{pair}, artifact_date date, gcs_uri string")
    verdicts = spark.createDataFrame([], f"{pair}, outcome string")
    outcomes = outcomes_of(spark, (1,))
    for action, deliveries in (("load_only", outcomes), ("ingest_and_load", outcomes.limit(0))):
        plan = spark.createDataFrame([(DAY[1], "orders", action)], f"{pair}, action string")
        with pytest.raises(ValueError):
            apply_plan(spark, database, plan, none, deliveries, outcomes, verdicts, rows_of(spark), "r")
    assert not spark.catalog.tableExists(f"{database}.replay_events")


def test_a_failed_load_spares_its_siblings(spark, database):
    good = rows_of(spark)

    def get(source):
        if source == "payments":
            raise RuntimeError("secret-customer-value")
        return good(source)

    outcomes = outcomes_of(spark, (1,))
    done = replay_range(spark, database, day_frame(spark, 1), outcomes, outcomes, get, "run-1", lambda: CLOCK)
    assert progress(done) == {1: "incomplete"}
    events = spark.table(f"{database}.replay_events")
    last = {r.source_object: r for r in ledger.latest_attempt_per_source(events).collect()}
    assert {s: r.status for s, r in last.items()} == {
        "orders": "success", "order_items": "success", "reviews": "success", "payments": "failed",
    }
    assert "secret" not in last["payments"].error_message
    assert_ledgers_legal(spark, database)
