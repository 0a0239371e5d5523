"""Ingestion-run rows: outcome of each delivered file and roll-up per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_error

# Failure category, operation and message of each phase, in phase order.
PHASES = {
    "validate": ("source_validation_failed", "validate_source", "Source validation failed"),
    "count": ("record_count_failed", "count_records", "Record counting failed"),
    "land": ("storage_write_failed", "save_file", "Raw landing failed"),
}

RUN_COLUMNS = (
    "ingestion_id", "source_system", "source_object", "source_file_name", "started_at",
    "completed_at", "landing_path", "file_size_bytes", "checksum", "record_count", "status",
    "error_message", "schema_version",
)


def failed_phase(valid: Column, counted: Column, landed: Column) -> Column:
    """First phase that failed, null when all passed."""
    no = F.lit(False)
    return (
        F.when(~F.coalesce(valid, no), "validate")
        .when(~F.coalesce(counted, no), "count")
        .when(~F.coalesce(landed, no), "land")
    )


def classify(files: DataFrame, component: str = "connector") -> DataFrame:
    """Set status, error text and the success-only facts of each file.

    Needs ``valid``, ``counted`` and ``landed`` flags.  A failed run carries no
    landing facts.
    """
    phase = F.col("failed_phase")
    error = F.lit(None).cast("string")
    for name, (category, operation, message) in PHASES.items():
        error = F.when(phase == name, safe_error(category, component, operation, message)).otherwise(error)
    judged = files.withColumn(
        "failed_phase", failed_phase(F.col("valid"), F.col("counted"), F.col("landed"))
    )
    ok = phase.isNull()
    facts = {
        name: F.when(ok, F.col(name))
        for name in ("landing_path", "file_size_bytes", "checksum", "record_count")
    }
    return judged.withColumns(
        {"status": F.when(ok, "success").otherwise("failed"), "error_message": error, **facts}
    )


def batch_status(runs: DataFrame, *keys: str) -> DataFrame:
    """Status, counts and exit code of each batch; skipped counts as not failed.

    A batch without rows cannot appear; callers find it with ``empty_batches``.
    """
    status = F.col("status")
    counted = runs.groupBy(*keys).agg(
        F.count_if(status == "success").alias("succeeded"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
        F.count(F.lit(1)).alias("total"),
    )
    failed = F.col("failed")
    outcome = (
        F.when(failed == 0, "success").when(failed == F.col("total"), "failed").otherwise("partial_failure")
    )
    code = F.when(failed == 0, 0).when(failed == F.col("total"), 2).otherwise(1)
    return counted.withColumns({"batch_status": outcome, "exit_code": code})


def run_json(runs: DataFrame) -> DataFrame:
    """Each run as one JSON object, nulls kept, timestamps in UTC with offset.

    The microsecond part is printed only when there is one.
    """
    stamped = runs.select(*[_json_field(runs, c) for c in RUN_COLUMNS])
    body = F.to_json(F.struct(*RUN_COLUMNS), {"ignoreNullFields": "false"})
    return stamped.select("ingestion_id", body.alias("json"))


def _json_field(runs: DataFrame, name: str) -> Column:
    if runs.schema[name].dataType.typeName() != "timestamp":
        return F.col(name)
    whole = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(name, ".SSSSSS")
    shown = F.when(micros == ".000000", "").otherwise(micros)
    return F.concat(whole, shown, F.lit("+00:00")).alias(name)
