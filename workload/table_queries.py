"""Raw tables and ledger tables written from the supplied tables and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaykit.functions.dates import historical_ingestion_date
from replaykit.operators import inspection, reconciliation, recovery
from replaykit.operators.checks import run_rules, violations
from replaykit.operators.slicing import DATED_BY, expected_grid
from replaykit.plans.apply import recover_files, recovery_summary
from replaykit.plans.attempts import Stamps, append_artifacts, append_loads, attempt_of, derived_id, load_sources
from replaykit.plans.ingest import delivered_rows, deliveries_of, judge
from replaykit.plans.initial import initial_load
from replaykit.plans.replay import replay_files
from replaykit.session import drop_tables, shared_dir, written_so_far, written_table
from replaykit.sources import tables
from replaykit.sources.registry import DAILY_SOURCES, MASTER_SOURCES, columns_of

from . import bindings as b
from .catalog import query
from .daily import BY_DAY, RAW_SQL, daily_rows, master_rows, period, period_sql, stacked, stacked_sql
from .file_queries import CSV
from .sqltext import cte, sql

RUN_CLOCK = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def fresh_database(spark: SparkSession) -> str:
    name = f"replaykit_{uuid.uuid4().hex[:12]}"
    tables.create_database(spark, name, shared_dir(spark, name))
    return name


_MASTERS = stacked_sql({s: RAW_SQL[s] for s in MASTER_SOURCES})
_MASTER_CTES = tuple(RAW_SQL[s] for s in MASTER_SOURCES)


def _stacked(spark, names: dict[str, str]) -> DataFrame:
    return stacked({source: spark.table(name) for source, name in names.items()})


@query("master_full_load", sql(_MASTERS, *_MASTER_CTES))
def master_full_load(spark, sf):
    rows = master_rows(spark, sf)
    outcomes = None
    for source, df in rows.items():
        part = df.groupBy().agg(
            F.lit(source).alias("source_object"),
            F.when(F.count(F.lit(1)) >= 0, "success").otherwise("failed").alias("status"),
        )
        outcomes = part if outcomes is None else outcomes.unionByName(part)
    return _stacked(spark, initial_load(spark, fresh_database(spark), outcomes, rows.__getitem__))


@query("raw_master_replace", sql(_MASTERS, *_MASTER_CTES))
def raw_master_replace(spark, sf):
    """First loaded doubled, then replaced twice: only the last content remains."""
    database = fresh_database(spark)
    names = {}
    for source, rows in master_rows(spark, sf).items():
        tables.replace_master(rows.unionByName(rows), database, source)
        for _ in range(2):
            names[source] = tables.replace_master(rows, database, source)
    return _stacked(spark, names)


# by number of the day or of the month, in words that both engines understand
_NUMBER = "(extract(year FROM delivery_date) * 372 + extract(month FROM delivery_date) * 31 + extract(day FROM delivery_date))" if BY_DAY else "(extract(year FROM delivery_date) * 12 + extract(month FROM delivery_date))"
EMPTIED, CHANGED = f"{_NUMBER} % 7 = 0", f"{_NUMBER} % 5 = 0"


def replaced_days(spark, sf) -> str:
    """All days of the daily sources loaded, then every fifth replayed changed and every seventh with zero rows, twice.

    Children of orders are sliced once for the three writes and the lists of their days.
    """
    database = fresh_database(spark)
    emptied, changed = F.expr(EMPTIED), F.expr(CHANGED)
    for source, rows in daily_rows(spark, sf).items():
        sliced = source not in DATED_BY
        rows = written_table(rows, "sliced") if sliced else rows
        tables.replace_partitions(rows, database, source, rows)
        replayed = rows.filter(emptied | changed).select("delivery_date").distinct()
        last = columns_of(source)[-1]
        replay = rows.filter(changed & ~emptied).withColumn(last, F.concat(F.lit("X"), last))
        for _ in range(2):
            tables.replace_partitions(replay, database, source, replayed)
        if sliced:
            drop_tables(spark, written_so_far()[-1:])
    return database


_DAILY_SQL = {s: RAW_SQL[s] for s in DAILY_SOURCES}
for _source, _name in _DAILY_SQL.items():
    _last = columns_of(_source)[-1]
    cte(f"replaced_{_source}", f"""
SELECT * REPLACE (CASE WHEN {CHANGED} THEN 'X' ELSE '' END || {_last} AS {_last}) FROM {_name} WHERE NOT ({EMPTIED})
""")
_REPLACED = {s: f"replaced_{s}" for s in DAILY_SOURCES}
_REPLACED_CTES = (*_DAILY_SQL.values(), *_REPLACED.values())


@query("raw_partition_replace", sql(stacked_sql(_REPLACED, "delivery_date"), *_REPLACED_CTES))
def raw_partition_replace(spark, sf):
    database = replaced_days(spark, sf)
    return stacked({s: spark.table(f"{database}.{s}") for s in DAILY_SOURCES}, "delivery_date")


_RESULTS = " UNION ALL ".join(f"""
SELECT '{s}' AS source_object, 'gs://bucket/{s}.csv' AS source_uri, 'db.raw.{s}$' || strftime(d.delivery_date, '%Y%m%d') AS destination,
       d.delivery_date AS partition_date, count(r.order_id) AS output_rows, 'job-1' AS job_id
FROM (SELECT DISTINCT delivery_date FROM {_DAILY_SQL[s]}) d LEFT JOIN {_REPLACED[s]} r USING (delivery_date) GROUP BY d.delivery_date
""" for s in DAILY_SOURCES)


@query("load_results", sql(_RESULTS, *_REPLACED_CTES))
def load_results(spark, sf):
    database = replaced_days(spark, sf)
    expected, counts = None, None
    for source in DAILY_SOURCES:
        listed = tables.registered_partitions(spark, database, source)
        counted = tables.partition_counts(spark, database, source)
        expected = listed if expected is None else expected.unionByName(listed)
        counts = counted if counts is None else counts.unionByName(counted)
    expected = expected.withColumnRenamed("partition_date", "delivery_date")
    uri = F.concat(F.lit("gs://bucket/"), "source_object", F.lit(".csv"))
    return tables.load_results(expected, counts, b.DATASET, uri, "job-1")


@query("append_events", sql("""
SELECT run_id, event_id, delivery_date, source_object, status, stage, started_at, completed_at, error_message, recorded_at
FROM replay_events
""", "replay_events"))
def append_events(spark, sf):
    """Events with some sent twice, and the whole insert retried."""
    database = fresh_database(spark)
    events = b.replay_events(spark, sf)
    sent = events.unionByName(events.filter(F.col("event_id").cast("bigint") % 10 == 0))
    for _ in range(2):
        tables.append_ledger(sent, database, "replay_events")
    return spark.table(f"{database}.replay_events")


def _placed(df: DataFrame) -> DataFrame:
    return df.withColumn("delivery_date", period(F.col("delivery_date")))


@query("append_provenance", sql(f"""
SELECT 'artifact' AS ledger, provenance_id AS row_id, {period_sql("delivery_date")} AS delivery_date, recorded_at FROM artifacts
UNION ALL SELECT 'load', load_id, {period_sql("delivery_date")}, recorded_at FROM loads
""", "jobs", "job_facts", "artifacts", "loads"))
def append_provenance(spark, sf):
    database = fresh_database(spark)
    for _ in range(2):
        tables.append_ledger(_placed(b.artifacts(spark, sf)), database, "artifact_provenance")
        tables.append_ledger(_placed(b.loads(spark, sf)), database, "load_provenance")
    artifact = spark.table(f"{database}.artifact_provenance").select(
        F.lit("artifact").alias("ledger"), F.col("provenance_id").alias("row_id"), "delivery_date", "recorded_at"
    )
    load = spark.table(f"{database}.load_provenance").select(
        F.lit("load").alias("ledger"), F.col("load_id").alias("row_id"), "delivery_date", "recorded_at"
    )
    return artifact.unionByName(load)


@query("ledger_ddl", sql("""
SELECT delivery_date, count(*) AS n_events FROM replay_events GROUP BY 1
""", "replay_events"))
def ledger_ddl(spark, sf):
    """The ledger table created twice, filled, and listed by its partitions."""
    database = fresh_database(spark)
    tables.create_ledger(spark, database, "replay_events")
    table = tables.create_ledger(spark, database, "replay_events")
    tables.append_ledger(b.replay_events(spark, sf), database, "replay_events")
    day = F.regexp_extract("partition", "delivery_date=(.*)$", 1).cast("date").alias("delivery_date")
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(day)
    counted = spark.table(table).groupBy("delivery_date").agg(F.count(F.lit(1)).alias("n_events"))
    return listed.join(counted, "delivery_date")


# --- whole jobs ------------------------------------------------------------------


FAILED_DAY = dt.date(1999, 6, 1)
STORE = "gs://bucket"
_ROOTS: dict[tuple[str, str, bool], str] = {}


def delivered_files(spark, sf, mended: bool) -> str:
    """One file per period and daily source, of zero records where there are none; unless mended, payments of one period lack a column."""
    key = (spark.sparkContext.applicationId, sf, mended)
    if key not in _ROOTS:
        root = shared_dir(spark, "replayed")
        days = periods(spark, sf)
        for source, rows in daily_rows(spark, sf).items():
            bad = (F.col("delivery_date") == F.lit(FAILED_DAY)) & F.lit(source == "payments" and not mended)
            placed = rows.repartition("delivery_date")
            placed.filter(~bad).write.mode("append").options(**CSV).partitionBy("delivery_date").csv(f"{root}/{source}")
            if source == "payments" and not mended:
                placed.filter(bad).drop(columns_of(source)[-1]).write.mode("append").options(**CSV).partitionBy("delivery_date").csv(f"{root}/{source}")
            header = days.join(rows, "delivery_date", "left_anti").select(F.lit(",".join(columns_of(source))).alias("line"), "delivery_date")
            header.repartition("delivery_date").write.mode("append").options(sep="\t", header="false").partitionBy("delivery_date").csv(f"{root}/{source}")
        _ROOTS[key] = root
    return _ROOTS[key]


def periods(spark, sf) -> DataFrame:
    rows = daily_rows(spark, sf)
    return rows["orders"].select("delivery_date").unionByName(rows["reviews"].select("delivery_date")).distinct()


def replayed(spark, sf) -> tuple[str, DataFrame]:
    """A replay of all periods from their files, whose payments fail in one of them."""
    database = fresh_database(spark)
    root = delivered_files(spark, sf, False)
    landing = historical_ingestion_date(F.col("delivery_date"))
    return database, replay_files(spark, database, root, periods(spark, sf), landing, STORE, "replay-1", lambda: RUN_CLOCK)


cte("periods", """
SELECT DISTINCT delivery_date FROM (SELECT delivery_date FROM delivered_orders UNION ALL SELECT delivery_date FROM delivered_reviews)
""")
_FAILED = f"DATE '{FAILED_DAY}'"
_PERIOD_CTES = ("delivered_orders", "delivered_items", "delivered_payments", "delivered_reviews", "periods")


@query("replay_range", sql(f"""
SELECT delivery_date, CASE WHEN delivery_date < {_FAILED} THEN 4 WHEN delivery_date = {_FAILED} THEN 3 ELSE 0 END AS n_completed,
       0 AS n_unexpected, delivery_date < {_FAILED} AS complete,
       CASE WHEN delivery_date < {_FAILED} THEN 'complete' WHEN delivery_date = {_FAILED} THEN 'incomplete' ELSE 'not_attempted' END AS progress
FROM periods
""", *_PERIOD_CTES))
def replay(spark, sf):
    """From files to ledger: the range stops at its failed period, and later ones are untouched."""
    return replayed(spark, sf)[1]


_LANDED = " UNION ALL ".join(f"""
SELECT '{s}' AS source_object, p.delivery_date, count(r.order_id) AS record_count, p.delivery_date = {_FAILED} AND '{s}' = 'payments' AS bad
FROM periods p LEFT JOIN {_DAILY_SQL[s]} r USING (delivery_date) WHERE p.delivery_date <= {_FAILED} GROUP BY p.delivery_date""" for s in DAILY_SOURCES)


@query("ingestion_runs", sql(f"""
SELECT source_object, delivery_date, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status, CASE WHEN NOT bad THEN record_count END AS record_count, NOT bad AS claimed, TRUE AS legal
FROM ({_LANDED})
""", *_PERIOD_CTES))
def stored_runs(spark, sf):
    """The stored run rows of a replay, repeated under its id after a crash, with their claims and their row checks."""
    database, _ = replayed(spark, sf)
    root, landing = delivered_files(spark, sf, False), historical_ingestion_date(F.col("delivery_date"))
    replay_files(spark, database, root, periods(spark, sf), landing, STORE, "replay-1", lambda: RUN_CLOCK)
    runs = spark.table(f"{database}.ingestion_runs")
    claims = spark.table(f"{database}.landing_manifest").select("landing_path", "delivery_date")
    day = F.date_sub(F.to_date(F.regexp_extract("landing_path", "ingestion_date=([0-9-]+)", 1)), 1)
    illegal = violations(runs, run_rules(), ["ingestion_id"]).select("ingestion_id", F.lit(False).alias("legal"))
    found = runs.join(claims, "landing_path", "left").join(illegal, "ingestion_id", "left")
    failed = F.lit(FAILED_DAY)
    return found.select(
        "source_object", F.when(F.col("landing_path").isNull(), failed).otherwise(F.coalesce("delivery_date", day)).alias("delivery_date"), "status",
        "record_count", F.col("delivery_date").isNotNull().alias("claimed"), F.coalesce("legal", F.lit(True)).alias("legal"),
    )


_MONTH = "extract(month FROM delivery_date)"


@query("apply_plan", sql(f"""
SELECT delivery_date, CASE WHEN delivery_date < {_FAILED} THEN 0 WHEN delivery_date = {_FAILED} THEN 1 WHEN {_MONTH} % 4 = 2 THEN 3 ELSE 4 END AS succeeded,
       0 AS failed, CASE WHEN delivery_date < {_FAILED} THEN 4 WHEN delivery_date = {_FAILED} THEN 3 ELSE 0 END AS skipped,
       CASE WHEN delivery_date > {_FAILED} AND {_MONTH} % 4 = 2 THEN 1 ELSE 0 END AS blocked, NOT (delivery_date > {_FAILED} AND {_MONTH} % 4 = 2) AS date_complete
FROM periods
""", *_PERIOD_CTES))
def apply(spark, sf):
    """After the stopped replay and three kinds of crash, a plan over all periods does what each pair needs; all five actions occur.

    Orders behind the stop had landed without a load, were loaded without their success event, or stood in the table without any evidence.
    """
    database, _ = replayed(spark, sf)
    root = delivered_files(spark, sf, True)
    landing = historical_ingestion_date(F.col("delivery_date"))
    outcomes = judge(spark, database, root, landing, "crashed-1")
    late = written_table(deliveries_of(outcomes, STORE).filter((F.col("delivery_date") > F.lit(FAILED_DAY)) & (F.col("source_object") == "orders")), "crashed")
    kind, stamp = F.month("delivery_date") % 4, Stamps(lambda: RUN_CLOCK + dt.timedelta(hours=1))
    attempt = attempt_of(stamp())
    crashed = late.withColumn("provenance_id", derived_id("crashed-1", "artifact", attempt))
    append_artifacts(crashed.filter(kind.isin(0, 1)), database, "crashed-1", stamp())
    load_sources(crashed.filter(kind.isin(1, 2)), database, delivered_rows(spark, root, outcomes))
    append_loads(crashed.filter(kind == 1), database, "crashed-1", attempt, stamp())

    pairs = expected_grid(periods(spark, sf)).select("delivery_date", "source_object")
    artifacts = spark.table(f"{database}.artifact_provenance")
    listing = artifacts.select("gcs_uri", "checksum", "file_size_bytes").distinct()
    seen = inspection.artifact_observation(artifacts, listing)
    partitions, counts = None, None
    for source in DAILY_SOURCES:
        listed = tables.registered_partitions(spark, database, source)
        counted = tables.partition_counts(spark, database, source)
        partitions = listed if partitions is None else partitions.unionByName(listed)
        counts = counted if counts is None else counts.unionByName(counted)
    table_seen = inspection.partition_observation(pairs, partitions, counts, database)
    plan = written_table(recovery.plan(recovery.evidence(pairs, spark.table(f"{database}.replay_events"), artifacts, table_seen)), "plan")
    verdicts = written_table(reconciliation.reconcile(pairs, spark.table(f"{database}.load_provenance"), artifacts, seen, table_seen), "verdicts")
    supplied = plan.filter(F.col("action") == "load_only").join(
        artifacts.select("delivery_date", "source_object", "gcs_uri"), ["delivery_date", "source_object"]
    ).select("delivery_date", "source_object", F.col("delivery_date").alias("artifact_date"), "gcs_uri")
    results = recover_files(
        spark, database, root, plan, written_table(supplied, "supplied"), verdicts, landing, STORE, "recovery-1", lambda: RUN_CLOCK + dt.timedelta(days=1)
    )
    return recovery_summary(spark, database, results)
