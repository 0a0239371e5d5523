"""Provenance, physical inspection, reconciliation and recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from replaykit.functions.paths import has_uri_scheme, uri_bucket, uri_ingestion_date, uri_object
from replaykit.operators import inspection, provenance, recovery
from replaykit.operators.checks import (
    artifact_observation_rules,
    artifact_rules,
    load_rules,
    partition_observation_rules,
    reconciliation_rules,
    violations,
)
from replaykit.operators.reconciliation import reconcile
from replaykit.session import written_table

from . import bindings as b
from .catalog import query
from .sqltext import cte, sql

ARTIFACT = ("jobs", "job_facts", "artifacts")
LOAD = ("jobs", "job_facts", "loads")
ARTIFACT_COLUMNS = (
    "provenance_id, run_id, delivery_date, source_object, ingestion_date, gcs_uri, checksum, "
    "file_size_bytes, record_count, recorded_at"
)
LOAD_COLUMNS = (
    "load_id, provenance_id, run_id, delivery_date, source_object, destination, partition_date, "
    "output_rows, job_id, recorded_at"
)


@query("artifact_by_id", sql(
    f"SELECT {ARTIFACT_COLUMNS} FROM artifacts WHERE provenance_id IN (SELECT provenance_id FROM loads)",
    *ARTIFACT, "loads"))
def artifact_by_id(spark, sf):
    return provenance.artifact_by_id(b.artifacts(spark, sf), b.loads(spark, sf))


@query("artifact_history", sql(f"SELECT {ARTIFACT_COLUMNS} FROM artifacts", *ARTIFACT))
def artifact_history(spark, sf):
    return provenance.artifact_history(b.artifacts(spark, sf), b.pairs(spark, sf))


def _repeated_uris(spark, sf):
    """Artifacts landed under one URI per week, so that a URI has several records."""
    week = F.date_format(F.date_trunc("week", F.col("delivery_date").cast("timestamp")), "yyyyMMdd")
    uri = F.concat(F.lit("gs://bucket/raw/"), "source_object", F.lit("/"), week)
    month = F.trunc("delivery_date", "month")
    return b.artifacts(spark, sf).withColumn("gcs_uri", uri).withColumn("delivery_date", month)


cte("repeated_uris", """
SELECT provenance_id, run_id, CAST(date_trunc('month', delivery_date) AS DATE) AS delivery_date, source_object,
       ingestion_date, 'gs://bucket/raw/' || source_object || '/' || strftime(date_trunc('week', delivery_date), '%Y%m%d') AS gcs_uri,
       checksum, file_size_bytes, record_count, recorded_at
FROM artifacts
""")


@query("artifact_by_uri", sql(f"""
SELECT {ARTIFACT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY delivery_date, source_object, gcs_uri
                               ORDER BY recorded_at DESC, provenance_id DESC) AS rn FROM repeated_uris)
WHERE rn = 1
""", *ARTIFACT, "repeated_uris"))
def artifact_by_uri(spark, sf):
    return provenance.artifact_by_uri(_repeated_uris(spark, sf))


@query("load_history", sql(f"SELECT {LOAD_COLUMNS} FROM loads", *LOAD))
def load_history(spark, sf):
    return provenance.load_history(b.loads(spark, sf), b.pairs(spark, sf))


cte("latest_loads", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY delivery_date, source_object
                               ORDER BY recorded_at DESC, load_id DESC) AS rn FROM loads)
WHERE rn = 1
""")


@query("latest_load", sql(f"SELECT {LOAD_COLUMNS} FROM latest_loads", *LOAD, "latest_loads"))
def latest_load(spark, sf):
    return provenance.latest_load(b.loads(spark, sf))


@query("lineage", sql("""
SELECT l.load_id, l.provenance_id, l.delivery_date, l.source_object, l.output_rows,
       a.delivery_date AS artifact_delivery_date, a.gcs_uri, a.checksum, a.record_count,
       a.provenance_id IS NULL AS is_orphan
FROM loads l LEFT JOIN artifacts a USING (provenance_id)
""", *ARTIFACT, "loads"))
def lineage(spark, sf):
    return provenance.lineage(b.loads(spark, sf), b.artifacts(spark, sf)).select(
        "load_id", "provenance_id", "delivery_date", "source_object", "output_rows",
        "artifact_delivery_date", "gcs_uri", "checksum", "record_count", "is_orphan",
    )


def faulty_provenance(spark, sf):
    residue = F.substring("provenance_id", 3, 10).cast("bigint") % 101
    return b.artifacts(spark, sf).select(
        "provenance_id",
        F.when(residue == 1, " ").otherwise(F.col("run_id")).alias("run_id"),
        F.when(residue == 2, None).otherwise(F.col("delivery_date")).alias("delivery_date"),
        "source_object",
        "ingestion_date",
        F.when(residue == 3, F.replace("gcs_uri", F.lit("gs:"), F.lit("s3:")))
        .otherwise(F.col("gcs_uri")).alias("gcs_uri"),
        F.when(residue == 4, "").otherwise(F.col("checksum")).alias("checksum"),
        F.when(residue == 5, -1).otherwise(F.col("file_size_bytes")).alias("file_size_bytes"),
        F.when(residue.isin(5, 6), -2).otherwise(F.col("record_count")).alias("record_count"),
        "recorded_at",
    )


cte("faulty_provenance", """
SELECT provenance_id, CASE WHEN r = 1 THEN ' ' ELSE run_id END AS run_id,
       CASE WHEN r <> 2 THEN delivery_date END AS delivery_date,
       CASE WHEN r = 3 THEN replace(gcs_uri, 'gs:', 's3:') ELSE gcs_uri END AS gcs_uri,
       CASE WHEN r = 4 THEN '' ELSE checksum END AS checksum,
       CASE WHEN r = 5 THEN -1 ELSE file_size_bytes END AS file_size_bytes,
       CASE WHEN r IN (5, 6) THEN -2 ELSE record_count END AS record_count
FROM (SELECT *, CAST(substr(provenance_id, 3) AS BIGINT) % 101 AS r FROM artifacts)
""")


def faulty_loads(spark, sf):
    residue = F.substring("load_id", 3, 10).cast("bigint") % 103
    return b.loads(spark, sf).withColumns({
        "destination": F.when(residue == 1, "\n").otherwise(F.col("destination")),
        "output_rows": F.when(residue == 2, -5).otherwise(F.col("output_rows")),
        "job_id": F.when(residue == 3, None).otherwise(F.col("job_id")),
    })


cte("faulty_loads", """
SELECT load_id, CASE WHEN r = 1 THEN chr(10) ELSE destination END AS destination,
       CASE WHEN r = 2 THEN -5 ELSE output_rows END AS output_rows, CASE WHEN r <> 3 THEN job_id END AS job_id
FROM (SELECT *, CAST(substr(load_id, 3) AS BIGINT) % 103 AS r FROM loads)
""")


@query("provenance_row_checks", sql("""
SELECT * FROM (
  SELECT 'artifact' AS ledger, provenance_id AS row_id, concat_ws(',',
    CASE WHEN trim(run_id) = '' THEN 'run_id_blank' END,
    CASE WHEN checksum = '' THEN 'checksum_blank' END,
    CASE WHEN delivery_date IS NULL THEN 'delivery_date_missing' END,
    CASE WHEN NOT starts_with(gcs_uri, 'gs://') THEN 'gcs_uri_scheme' END,
    CASE WHEN file_size_bytes < 0 THEN 'file_size_bytes_negative' END,
    CASE WHEN record_count < 0 THEN 'record_count_negative' END) AS broken_rules
  FROM faulty_provenance
  UNION ALL
  SELECT 'load', load_id, concat_ws(',',
    CASE WHEN trim(destination, chr(10)) = '' THEN 'destination_blank' END,
    CASE WHEN job_id IS NULL THEN 'job_id_blank' END,
    CASE WHEN output_rows < 0 THEN 'output_rows_negative' END)
  FROM faulty_loads)
WHERE broken_rules <> ''
""", *ARTIFACT, "loads", "faulty_provenance", "faulty_loads"))
def provenance_row_checks(spark, sf):
    artifact = violations(faulty_provenance(spark, sf), artifact_rules(), ["provenance_id"])
    load = violations(faulty_loads(spark, sf), load_rules(), ["load_id"])
    return artifact.select(
        F.lit("artifact").alias("ledger"), F.col("provenance_id").alias("row_id"), "broken_rules"
    ).unionByName(load.select(F.lit("load").alias("ledger"), F.col("load_id").alias("row_id"), "broken_rules"))


# --- physical inspection ------------------------------------------------------


def artifact_seen(spark, sf):
    return inspection.artifact_observation(b.artifacts(spark, sf), b.listing(spark, sf))


def partition_seen(spark, sf):
    partitions, counts = b.partition_state(spark, sf)
    return inspection.partition_observation(b.pairs(spark, sf), partitions, counts, b.DATASET)


SEEN = (*ARTIFACT, "listing", "artifact_seen")


@query("artifact_observation", sql(
    "SELECT gcs_uri, present, checksum, file_size_bytes FROM artifact_seen", *SEEN))
def artifact_observation(spark, sf):
    return artifact_seen(spark, sf)


@query("uri_parts", sql("""
SELECT provenance_id, nullif(regexp_extract(u, '^gs://([^/]+)/(.+)$', 1), '') AS bucket,
       nullif(regexp_extract(u, '^gs://([^/]+)/(.+)$', 2), '') AS object_name, starts_with(u, 'gs://') AS has_scheme
FROM (SELECT provenance_id, CASE CAST(substr(provenance_id, 3) AS BIGINT) % 10
             WHEN 1 THEN 'gs://bucket' WHEN 2 THEN 'gs:///x' WHEN 3 THEN replace(gcs_uri, 'gs:', 's3:')
             WHEN 4 THEN 'gs://bucket/' ELSE gcs_uri END AS u FROM artifacts)
""", *ARTIFACT))
def uri_parts(spark, sf):
    residue = F.substring("provenance_id", 3, 10).cast("bigint") % 10
    uri = (
        F.when(residue == 1, "gs://bucket")
        .when(residue == 2, "gs:///x")
        .when(residue == 3, F.replace("gcs_uri", F.lit("gs:"), F.lit("s3:")))
        .when(residue == 4, "gs://bucket/")
        .otherwise(F.col("gcs_uri"))
    )
    return b.artifacts(spark, sf).select(
        "provenance_id",
        uri_bucket(uri).alias("bucket"),
        uri_object(uri).alias("object_name"),
        has_uri_scheme(uri).alias("has_scheme"),
    )


@query("uri_ingestion_date", sql("""
SELECT provenance_id, TRY_CAST(nullif(regexp_extract(u, '(^|/)ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})(/|$)', 2), '') AS DATE)
       AS uri_date
FROM (SELECT provenance_id, CASE CAST(substr(provenance_id, 3) AS BIGINT) % 10
             WHEN 1 THEN 'gs://b/ingestion_date=2017-02-30/f.csv' WHEN 2 THEN 'ingestion_date=2017-05-01'
             WHEN 3 THEN 'gs://b/ingestion_date=2017-05-011/f.csv' WHEN 4 THEN 'gs://b/f?ingestion_date=2017-05-01/x'
             ELSE gcs_uri END AS u FROM artifacts)
""", *ARTIFACT))
def uri_dates(spark, sf):
    residue = F.substring("provenance_id", 3, 10).cast("bigint") % 10
    uri = (
        F.when(residue == 1, "gs://b/ingestion_date=2017-02-30/f.csv")
        .when(residue == 2, "ingestion_date=2017-05-01")
        .when(residue == 3, "gs://b/ingestion_date=2017-05-011/f.csv")
        .when(residue == 4, "gs://b/f?ingestion_date=2017-05-01/x")
        .otherwise(F.col("gcs_uri"))
    )
    return b.artifacts(spark, sf).select("provenance_id", uri_ingestion_date(uri).alias("uri_date"))


TABLE_SEEN = ("jobs", "pairs", "partition_rows", "partition_seen")


@query("partition_observation", sql(
    "SELECT source_object, partition_date, destination, present, row_count FROM partition_seen", *TABLE_SEEN))
def partition_observation(spark, sf):
    return partition_seen(spark, sf)


@query("observation_row_checks", sql("""
SELECT * FROM (
  SELECT 'artifact' AS kind, gcs_uri AS row_id, concat_ws(',',
    CASE WHEN NOT p AND checksum IS NOT NULL THEN 'absent_has_checksum' END,
    CASE WHEN NOT p AND file_size_bytes IS NOT NULL THEN 'absent_has_size' END) AS broken_rules
  FROM (SELECT *, present AND coalesce(file_size_bytes % 5 <> 0, TRUE) AS p FROM artifact_seen)
  UNION ALL
  SELECT 'partition', source_object || ' ' || partition_date, concat_ws(',',
    CASE WHEN NOT p AND n IS NOT NULL THEN 'absent_has_row_count' END, CASE WHEN n < 0 THEN 'row_count_negative' END)
  FROM (SELECT *, present AND coalesce(row_count % 7 <> 0, TRUE) AS p, row_count - 3 AS n FROM partition_seen))
WHERE broken_rules <> ''
""", *SEEN, "pairs", "partition_rows", "partition_seen"))
def observation_row_checks(spark, sf):
    true = F.lit(True)
    seen = artifact_seen(spark, sf).withColumn(
        "present", F.col("present") & F.coalesce(F.col("file_size_bytes") % 5 != 0, true)
    )
    table = partition_seen(spark, sf).withColumns({
        "present": F.col("present") & F.coalesce(F.col("row_count") % 7 != 0, true),
        "row_count": F.col("row_count") - 3,
    })
    key = F.concat_ws(" ", "source_object", F.col("partition_date").cast("string"))
    artifact = violations(seen, artifact_observation_rules(), ["gcs_uri"])
    partition = violations(table.withColumn("key", key), partition_observation_rules(), ["key"])
    return artifact.select(
        F.lit("artifact").alias("kind"), F.col("gcs_uri").alias("row_id"), "broken_rules"
    ).unionByName(
        partition.select(F.lit("partition").alias("kind"), F.col("key").alias("row_id"), "broken_rules")
    )


# --- reconciliation -----------------------------------------------------------

cte("chain", """
SELECT p.delivery_date, p.source_object, l.load_id, l.partition_date, l.destination, l.output_rows,
       a.provenance_id, a.delivery_date AS a_date, a.source_object AS a_source, a.ingestion_date, a.gcs_uri,
       a.checksum, a.file_size_bytes, a.record_count, o.present AS o_present, o.checksum AS o_checksum,
       o.file_size_bytes AS o_size, t.present AS t_present, t.destination AS t_destination, t.row_count AS t_rows,
       TRY_CAST(nullif(regexp_extract(a.gcs_uri, '(^|/)ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})(/|$)', 2), '') AS DATE) AS uri_date
FROM pairs p
LEFT JOIN latest_loads l USING (delivery_date, source_object)
LEFT JOIN artifacts a ON a.provenance_id = l.provenance_id
LEFT JOIN artifact_seen o ON o.gcs_uri = a.gcs_uri
LEFT JOIN partition_seen t ON t.source_object = p.source_object AND t.partition_date = p.delivery_date
""")
cte("reconciled", """
SELECT delivery_date, source_object, CASE WHEN reason = 'confirmed' THEN 'confirmed' ELSE 'blocked' END AS outcome, reason,
       CASE WHEN reason = 'confirmed' THEN provenance_id END AS provenance_id,
       CASE WHEN reason = 'confirmed' THEN load_id END AS load_id
FROM (SELECT *, CASE
  WHEN load_id IS NULL THEN 'no_warehouse_load_provenance'
  WHEN provenance_id IS NULL THEN 'no_artifact_provenance'
  WHEN partition_date IS DISTINCT FROM delivery_date OR a_date IS DISTINCT FROM delivery_date
    OR a_source IS DISTINCT FROM source_object THEN 'provenance_identity_mismatch'
  WHEN NOT coalesce(o_present, FALSE) THEN 'gcs_artifact_missing'
  WHEN o_checksum IS NULL THEN 'gcs_checksum_missing'
  WHEN o_checksum IS DISTINCT FROM checksum THEN 'gcs_checksum_mismatch'
  WHEN o_size IS DISTINCT FROM file_size_bytes THEN 'gcs_size_mismatch'
  WHEN uri_date IS NULL OR uri_date IS DISTINCT FROM ingestion_date THEN 'gcs_ingestion_date_mismatch'
  WHEN NOT coalesce(t_present, FALSE) THEN 'bigquery_partition_missing'
  WHEN t_destination IS DISTINCT FROM destination THEN 'bigquery_destination_mismatch'
  WHEN t_rows IS DISTINCT FROM output_rows OR output_rows IS DISTINCT FROM record_count THEN 'bigquery_row_count_mismatch'
  ELSE 'confirmed' END AS reason FROM chain)
""")
CHAIN = (*SEEN, "loads", "latest_loads", "pairs", "partition_rows", "partition_seen", "chain", "reconciled")


def reconciled(spark, sf):
    return reconcile(
        b.pairs(spark, sf), b.loads(spark, sf), b.artifacts(spark, sf), artifact_seen(spark, sf), partition_seen(spark, sf)
    )


@query("reconciliation", sql("SELECT * FROM reconciled", *CHAIN))
def reconciliation(spark, sf):
    return reconciled(spark, sf)


@query("reconciliation_row_checks", sql("""
SELECT * FROM (
  SELECT delivery_date, source_object, concat_ws(',',
    CASE WHEN outcome = 'confirmed' AND r <> 'confirmed' THEN 'confirmed_with_other_reason' END,
    CASE WHEN outcome = 'confirmed' AND (provenance_id IS NULL OR l IS NULL) THEN 'confirmed_without_ids' END,
    CASE WHEN outcome = 'blocked' AND r = 'confirmed' THEN 'blocked_with_confirmed_reason' END) AS broken_rules
  FROM (SELECT *, CASE WHEN d = 0 THEN 'gcs_size_mismatch' WHEN d = 1 THEN 'confirmed' ELSE reason END AS r,
               CASE WHEN d <> 2 THEN load_id END AS l
        FROM (SELECT *, extract(day FROM delivery_date) % 6 AS d FROM reconciled)))
WHERE broken_rules <> ''
""", *CHAIN))
def reconciliation_row_checks(spark, sf):
    residue = F.dayofmonth("delivery_date") % 6
    planted = reconciled(spark, sf).withColumns({
        "reason": F.when(residue == 0, "gcs_size_mismatch").when(residue == 1, "confirmed").otherwise(F.col("reason")),
        "load_id": F.when(residue != 2, F.col("load_id")),
    })
    return violations(planted, reconciliation_rules(), ["delivery_date", "source_object"])


# --- recovery -----------------------------------------------------------------
#
# Completion comes from a ledger of one event per order, a reusable artifact is one
# observed intact, and table presence is the partition observation.


def job_events(spark, sf):
    k = F.col("k")
    status = F.when(k % 9 == 0, "success").when(k % 4 < 2, "running").otherwise("failed")
    return b.jobs(spark, sf).select(
        F.concat(F.lit("run-"), (k % 7).cast("string")).alias("run_id"),
        b.padded("", k).alias("event_id"),
        "delivery_date",
        "source_object",
        status.alias("status"),
        F.when(status == "success", "warehouse").when(k % 2 == 0, "ingestion").otherwise("warehouse").alias("stage"),
        "recorded_at",
    )


cte("job_events", """
SELECT 'run-' || (k % 7) AS run_id, lpad(CAST(k AS VARCHAR), 10, '0') AS event_id, delivery_date, source_object, recorded_at,
       CASE WHEN k % 9 = 0 THEN 'success' WHEN k % 4 < 2 THEN 'running' ELSE 'failed' END AS status,
       CASE WHEN k % 9 = 0 THEN 'warehouse' WHEN k % 2 = 0 THEN 'ingestion' ELSE 'warehouse' END AS stage
FROM jobs
""")


def intact_artifacts(spark, sf):
    """Artifacts whose object is present with the recorded checksum and size."""
    seen = artifact_seen(spark, sf).select(
        "gcs_uri", F.col("checksum").alias("seen_checksum"), F.col("file_size_bytes").alias("seen_size")
    )
    return b.artifacts(spark, sf).join(seen, "gcs_uri").filter(
        (F.col("seen_checksum") == F.col("checksum")) & (F.col("seen_size") == F.col("file_size_bytes"))
    )


cte("intact", """
SELECT a.* FROM artifacts a JOIN artifact_seen o USING (gcs_uri)
WHERE o.checksum = a.checksum AND o.file_size_bytes = a.file_size_bytes
""")


def evidence_rows(spark, sf):
    return recovery.evidence(
        b.pairs(spark, sf), job_events(spark, sf), intact_artifacts(spark, sf), partition_seen(spark, sf)
    )


cte("evidence", """
SELECT p.delivery_date, p.source_object, coalesce(s.completed, FALSE) AS logical_completion,
       EXISTS (SELECT 1 FROM intact i WHERE i.delivery_date = p.delivery_date AND i.source_object = p.source_object) AS valid_raw,
       coalesce(t.present, FALSE) AS table_present, s.latest_status, s.latest_stage
FROM pairs p
LEFT JOIN (SELECT delivery_date, source_object, bool_or(status = 'success') AS completed,
                  arg_max(status, event_id) AS latest_status, arg_max(stage, event_id) AS latest_stage
           FROM job_events GROUP BY 1, 2) s USING (delivery_date, source_object)
LEFT JOIN partition_seen t ON t.source_object = p.source_object AND t.partition_date = p.delivery_date
""")
_WHEN = " ".join(f"WHEN '{action}' THEN '{text}'" for action, text in recovery.REASONS.items())
cte("plan", f"""
SELECT *, CASE action {_WHEN} END AS reason FROM (
  SELECT *, CASE WHEN logical_completion THEN 'skip' WHEN NOT valid_raw AND NOT table_present THEN 'ingest_and_load'
                 WHEN valid_raw AND NOT table_present THEN 'load_only' WHEN valid_raw THEN 'reconcile'
                 ELSE 'manual_review' END AS action FROM evidence)
""")
EVIDENCE = (*SEEN, "pairs", "partition_rows", "partition_seen", "job_events", "intact", "evidence")
PLAN = (*EVIDENCE, "plan")


@query("recovery_evidence", sql("SELECT * FROM evidence", *EVIDENCE))
def recovery_evidence(spark, sf):
    return evidence_rows(spark, sf)


def plan_rows(spark, sf):
    return recovery.plan(evidence_rows(spark, sf))


@query("recovery_plan", sql("SELECT * FROM plan", *PLAN))
def recovery_plan(spark, sf):
    return plan_rows(spark, sf).orderBy("delivery_date", "source_object")


@query("plan_checks", sql("""
SELECT plan_date, duplicate_sources, n_mixed_dates FROM (
  SELECT plan_date, coalesce(string_agg(CASE WHEN n > 1 THEN source_object END, ',' ORDER BY source_object), '') AS duplicate_sources,
         CAST(sum(n_other) AS BIGINT) AS n_mixed_dates
  FROM (SELECT plan_date, source_object, count(*) AS n,
               count(*) FILTER (WHERE delivery_date IS DISTINCT FROM plan_date) AS n_other
        FROM (SELECT delivery_date - CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END AS plan_date, * FROM jobs) GROUP BY 1, 2)
  GROUP BY 1)
WHERE duplicate_sources <> '' OR n_mixed_dates > 0
""", "jobs"))
def plan_checks(spark, sf):
    shifted = F.date_sub("delivery_date", F.when(F.col("k") % 23 == 0, 1).otherwise(0))
    return recovery.plan_checks(b.jobs(spark, sf).withColumn("plan_date", shifted))


@query("plan_summary", sql("""
SELECT delivery_date, count(*) FILTER (WHERE action IN ('ingest_and_load', 'load_only')) AS needs_execution,
       count(*) FILTER (WHERE action = 'reconcile') AS requires_reconciliation,
       count(*) FILTER (WHERE action = 'manual_review') AS requires_manual_review,
       count(*) FILTER (WHERE action = 'skip') AS skipped
FROM plan GROUP BY 1
""", *PLAN))
def plan_summary(spark, sf):
    return recovery.plan_summary(plan_rows(spark, sf))


def supplied_artifacts(spark, sf):
    """Intact artifacts with planted faults: some forgotten, doubled, misdated or not asked for."""
    k = F.substring("provenance_id", 3, 10).cast("bigint")
    return intact_artifacts(spark, sf).filter(k % 10 != 4).select(
        "delivery_date",
        "source_object",
        F.date_add("delivery_date", F.when(k % 14 == 2, 1).otherwise(0)).alias("artifact_date"),
        "gcs_uri",
    )


cte("supplied", """
SELECT delivery_date, source_object, delivery_date + CASE WHEN k % 14 = 2 THEN 1 ELSE 0 END AS artifact_date, gcs_uri
FROM (SELECT *, CAST(substr(provenance_id, 3) AS BIGINT) AS k FROM intact) WHERE k % 10 <> 4
""")


@query("recovery_request_checks", sql("""
SELECT delivery_date, source_object, problems FROM (
  SELECT delivery_date, source_object, concat_ws(',',
    CASE WHEN s.n > 1 THEN 'duplicate_artifact' END, CASE WHEN s.n_other > 0 THEN 'artifact_date_mismatch' END,
    CASE WHEN p.action IS NOT NULL AND s.n IS NULL THEN 'missing_artifact' END,
    CASE WHEN p.action IS NULL AND s.n > 0 THEN 'unexpected_artifact' END) AS problems
  FROM (SELECT delivery_date, source_object, count(*) AS n, count(*) FILTER (WHERE artifact_date <> delivery_date) AS n_other
        FROM supplied GROUP BY 1, 2) s
  FULL JOIN (SELECT * FROM plan WHERE action = 'load_only') p USING (delivery_date, source_object))
WHERE problems <> ''
""", *PLAN, "supplied"))
def recovery_request_checks(spark, sf):
    return recovery.request_checks(plan_rows(spark, sf), supplied_artifacts(spark, sf))


def plan_results(spark, sf):
    """Planned work carried out: ingestion and loading fail by day of month, reconciling by its verdict."""
    day = F.dayofmonth("delivery_date")
    verdict = reconciled(spark, sf).select("delivery_date", "source_object", F.col("outcome").alias("verdict"))
    joined = plan_rows(spark, sf).join(verdict, ["delivery_date", "source_object"], "left")
    return joined.select(
        "delivery_date",
        "source_object",
        "action",
        (day % 7 != 0).alias("ingest_ok"),
        ((day % 7 != 0) & (day % 5 != 0)).alias("load_ok"),
        (F.col("verdict") == "confirmed").alias("confirmed"),
    )


cte("results", """
SELECT delivery_date, source_object, action, d % 7 <> 0 AS ingest_ok, d % 7 <> 0 AND d % 5 <> 0 AS load_ok,
       outcome = 'confirmed' AS confirmed
FROM (SELECT p.*, r.outcome, extract(day FROM delivery_date) AS d
      FROM plan p LEFT JOIN reconciled r USING (delivery_date, source_object))
""")
RESULTS = (*CHAIN, "job_events", "intact", "evidence", "plan", "results")
cte("recovery_steps", """
SELECT delivery_date, source_object, action, 0 AS step,
       CASE WHEN action = 'reconcile' THEN 'success' ELSE 'running' END AS status,
       CASE WHEN action = 'ingest_and_load' THEN 'ingestion' ELSE 'warehouse' END AS stage
FROM results WHERE action IN ('ingest_and_load', 'load_only') OR (action = 'reconcile' AND confirmed)
UNION ALL
SELECT delivery_date, source_object, action, 1,
       CASE WHEN action = 'load_only' THEN CASE WHEN load_ok THEN 'success' ELSE 'failed' END
            WHEN ingest_ok THEN 'running' ELSE 'failed' END,
       CASE WHEN action = 'load_only' OR ingest_ok THEN 'warehouse' ELSE 'ingestion' END
FROM results WHERE action IN ('ingest_and_load', 'load_only')
UNION ALL
SELECT delivery_date, source_object, action, 2, CASE WHEN load_ok THEN 'success' ELSE 'failed' END, 'warehouse'
FROM results WHERE action = 'ingest_and_load' AND ingest_ok
""")


@query("recovery_events", sql("""
SELECT delivery_date, source_object, action, step, status, stage, 'recovery-1' AS run_id,
       sha256('recovery-1|' || delivery_date || '|' || source_object || '|' || step || '|' || status || '|' || stage) AS event_id
FROM recovery_steps
""", *RESULTS, "recovery_steps"))
def recovery_events(spark, sf):
    return recovery.recovery_events(plan_results(spark, sf), "recovery-1").drop("ingest_ok", "load_ok", "confirmed")


cte("legal", "SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', '{o}', '{i}', {str(w).upper()}, '{r}')" for a, o, i, w, r in recovery.LEGAL_RESULTS
) + ") AS t(action, outcome, ingest_status, has_load, reconciliation)")


@query("recovery_result_checks", sql("""
SELECT c.* FROM (
  SELECT delivery_date, source_object, action,
         ['succeeded', 'failed', 'skipped', 'blocked'][1 + CAST(d % 4 AS INTEGER)] AS outcome,
         CASE WHEN action = 'ingest_and_load' THEN CASE WHEN ingest_ok THEN 'success' ELSE 'failed' END ELSE 'none' END AS ingest_status,
         load_ok AS has_load,
         CASE WHEN action <> 'reconcile' THEN 'none' WHEN confirmed THEN 'confirmed' ELSE 'blocked' END AS reconciliation
  FROM (SELECT *, extract(day FROM delivery_date) AS d FROM results)) c
ANTI JOIN legal l USING (action, outcome, ingest_status, has_load, reconciliation)
""", *RESULTS, "legal"))
def recovery_result_checks(spark, sf):
    outcome = F.element_at(
        F.array(*[F.lit(o) for o in ("succeeded", "failed", "skipped", "blocked")]),
        F.dayofmonth("delivery_date") % 4 + 1,
    )
    ingest = F.when(
        F.col("action") == "ingest_and_load", F.when(F.col("ingest_ok"), "success").otherwise("failed")
    ).otherwise("none")
    verdict = F.when(F.col("action") != "reconcile", "none").when(F.col("confirmed"), "confirmed").otherwise("blocked")
    results = plan_results(spark, sf).select(
        "delivery_date",
        "source_object",
        "action",
        outcome.alias("outcome"),
        ingest.alias("ingest_status"),
        F.col("load_ok").alias("has_load"),
        verdict.alias("reconciliation"),
    )
    return recovery.result_checks(results)


@query("recovery_outcome_summary", sql("""
SELECT r.*, coalesce(d.n_known, 0) = 4 AND coalesce(d.n_other, 0) = 0 AS date_complete
FROM (SELECT delivery_date, count(*) FILTER (WHERE o = 'succeeded') AS succeeded, count(*) FILTER (WHERE o = 'failed') AS failed,
             count(*) FILTER (WHERE o = 'skipped') AS skipped, count(*) FILTER (WHERE o = 'blocked') AS blocked
      FROM (SELECT delivery_date, CASE action WHEN 'skip' THEN 'skipped' WHEN 'manual_review' THEN 'blocked'
                   WHEN 'reconcile' THEN CASE WHEN confirmed THEN 'succeeded' ELSE 'blocked' END
                   ELSE CASE WHEN load_ok THEN 'succeeded' ELSE 'failed' END END AS o FROM results) GROUP BY 1) r
LEFT JOIN (SELECT delivery_date, count(DISTINCT source_object) AS n_known, 0 AS n_other
           FROM (SELECT delivery_date, source_object FROM job_events WHERE status = 'success'
                 UNION ALL SELECT delivery_date, source_object FROM recovery_steps WHERE status = 'success') GROUP BY 1) d
USING (delivery_date)
""", *RESULTS, "recovery_steps"))
def recovery_outcome_summary(spark, sf):
    # Read twice below, so the decided plan is written once.
    results = written_table(plan_results(spark, sf), "plan-results")
    after = recovery.recovery_events(results, "recovery-1").select(
        "run_id",
        "event_id",
        "delivery_date",
        "source_object",
        "status",
        "stage",
        (F.lit("2002-01-01").cast("timestamp")).alias("recorded_at"),
    )
    events = job_events(spark, sf).unionByName(after)
    return recovery.outcome_summary(results.withColumn("outcome", recovery.result_outcome()), events)
