"""Row invariants: every rule of a table is evaluated in one pass.

A rule is ``(name, broken)`` where ``broken`` is true for a violating row.  A
rule whose predicate is null counts as not broken, so predicates spell out what
a null means for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import has_uri_scheme
from ..functions.text import is_blank
from ..sources.registry import SOURCES

Rule = tuple[str, Column]

# The legal states of replay events, runs and results.
EVENT_STATUSES = ("running", "success", "failed")
EVENT_STAGES = ("source_delivery", "ingestion", "warehouse")
RUN_STATUSES = ("started", "success", "failed", "skipped")


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules of a row, in rule order."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def any_broken(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(broken, F.lit(False)) for _, broken in rules])


def violations(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Violating rows with ``broken_rules`` as comma-separated names.

    The names pass through a one-element explode, below which no filter can be
    pushed: otherwise every rule, with the expressions behind its columns, would
    be copied into a filter and evaluated again.
    """
    names = F.array(F.array_join(broken_rules(rules), ","))
    return df.select(*keep, F.explode_outer(names).alias("broken_rules")).filter(F.col("broken_rules") != "")


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Same rows, but the job fails as soon as one row breaks a rule."""
    message = F.concat(F.lit("broken rules: "), F.array_join(broken_rules(rules), ","))
    return df.filter(F.when(any_broken(rules), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def blank(*columns: str) -> list[Rule]:
    return [(f"{name}_blank", is_blank(F.col(name))) for name in columns]


def absent(*columns: str) -> list[Rule]:
    return [(f"{name}_missing", F.col(name).isNull()) for name in columns]


def negative(*columns: str) -> list[Rule]:
    return [(f"{name}_negative", F.col(name) < 0) for name in columns]


def not_in(column: str, allowed: Sequence[str]) -> Rule:
    return (f"{column}_unknown", F.coalesce(~F.col(column).isin(*allowed), F.lit(True)))


def event_rules() -> list[Rule]:
    """Replay events: success is end-to-end, running is open, failed is closed."""
    status, completed, error = F.col("status"), F.col("completed_at"), F.col("error_message")
    return [
        *blank("run_id", "event_id", "source_object"),
        *absent("delivery_date", "started_at", "recorded_at"),
        not_in("status", EVENT_STATUSES),
        not_in("stage", EVENT_STAGES),
        ("completed_before_started", completed < F.col("started_at")),
        ("error_message_blank", error.isNotNull() & is_blank(error)),
        ("running_has_completed_at", (status == "running") & completed.isNotNull()),
        ("running_has_error", (status == "running") & error.isNotNull()),
        ("success_not_warehouse", (status == "success") & ~F.col("stage").eqNullSafe("warehouse")),
        ("success_without_completed_at", (status == "success") & completed.isNull()),
        ("success_has_error", (status == "success") & error.isNotNull()),
        ("failed_without_completed_at", (status == "failed") & completed.isNull()),
    ]


def artifact_rules() -> list[Rule]:
    return [
        *blank("provenance_id", "run_id", "source_object", "gcs_uri", "checksum"),
        *absent("delivery_date", "ingestion_date", "file_size_bytes", "record_count", "recorded_at"),
        ("gcs_uri_scheme", ~has_uri_scheme(F.col("gcs_uri"))),
        *negative("file_size_bytes", "record_count"),
    ]


def load_rules() -> list[Rule]:
    return [
        *blank("load_id", "provenance_id", "run_id", "source_object", "destination", "job_id"),
        *absent("delivery_date", "partition_date", "output_rows", "recorded_at"),
        *negative("output_rows"),
    ]


def run_rules() -> list[Rule]:
    """Ingestion runs: which fields each lifecycle state must and must not carry."""
    status, completed, error = F.col("status"), F.col("completed_at"), F.col("error_message")
    facts = ("landing_path", "file_size_bytes", "checksum", "record_count")
    started_extra = [
        (f"started_has_{name}", (status == "started") & F.col(name).isNotNull())
        for name in ("completed_at", *facts, "error_message")
    ]
    success_missing = [
        (f"success_without_{name}", (status == "success") & F.col(name).isNull())
        for name in ("completed_at", *facts)
    ]
    closed = status.isin("failed", "skipped")
    return [
        *blank("source_system", "source_object", "source_file_name"),
        ("schema_version_blank", F.col("schema_version").isNotNull() & is_blank(F.col("schema_version"))),
        *absent("started_at"),
        not_in("status", RUN_STATUSES),
        ("completed_before_started", completed < F.col("started_at")),
        *negative("file_size_bytes", "record_count"),
        *started_extra,
        *success_missing,
        ("success_landing_path_blank",
         (status == "success") & F.col("landing_path").isNotNull() & is_blank(F.col("landing_path"))),
        ("success_checksum_blank",
         (status == "success") & F.col("checksum").isNotNull() & is_blank(F.col("checksum"))),
        ("closed_without_completed_at", closed & completed.isNull()),
        ("closed_without_error", closed & is_blank(error)),
    ]


def delivery_rules() -> list[Rule]:
    return [*blank("source_object"), *absent("record_count"), *negative("record_count")]


def load_request_rules() -> list[Rule]:
    uri, source = F.col("uri"), F.col("source_object")
    return [
        *blank("source_object"),
        ("source_object_unsupported", ~is_blank(source) & ~source.isin(*SOURCES)),
        *blank("uri"),
        ("uri_scheme", ~is_blank(uri) & ~has_uri_scheme(uri)),
        *absent("partition_date"),
    ]


def artifact_observation_rules() -> list[Rule]:
    gone = ~F.col("present")
    return [
        *blank("gcs_uri"),
        ("gcs_uri_scheme", ~is_blank(F.col("gcs_uri")) & ~has_uri_scheme(F.col("gcs_uri"))),
        ("absent_has_checksum", gone & F.col("checksum").isNotNull()),
        ("absent_has_size", gone & F.col("file_size_bytes").isNotNull()),
        ("checksum_blank", F.col("checksum").isNotNull() & is_blank(F.col("checksum"))),
        *negative("file_size_bytes"),
    ]


def partition_observation_rules() -> list[Rule]:
    gone, rows = ~F.col("present"), F.col("row_count")
    return [
        *blank("source_object", "destination"),
        *absent("partition_date"),
        ("absent_has_row_count", gone & rows.isNotNull()),
        *negative("row_count"),
    ]


def reconciliation_rules() -> list[Rule]:
    confirmed, reason = F.col("outcome") == "confirmed", F.col("reason")
    return [
        *blank("source_object"),
        not_in("outcome", ("confirmed", "blocked")),
        ("confirmed_with_other_reason", confirmed & ~reason.eqNullSafe("confirmed")),
        ("confirmed_without_ids",
         confirmed & (F.col("provenance_id").isNull() | F.col("load_id").isNull())),
        ("blocked_with_confirmed_reason", (F.col("outcome") == "blocked") & (reason == "confirmed")),
        ("provenance_id_blank",
         F.col("provenance_id").isNotNull() & is_blank(F.col("provenance_id"))),
        ("load_id_blank", F.col("load_id").isNotNull() & is_blank(F.col("load_id"))),
    ]
