"""Recording attempted loads: events, provenance and the loads themselves.

Write order is artifact provenance, then load provenance, then the success
event, so a success is never recorded ahead of its evidence.  A crash in
between leaves exactly the state reconciliation resolves.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from py4j.protocol import Py4JNetworkError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import destination_id
from ..functions.text import safe_error
from ..operators.ledger import PAIR, explode_steps
from ..session import constant_table
from ..sources.registry import DAILY_SOURCES, is_transactional
from ..sources.tables import append_ledger, partition_counts, replace_partitions

log = logging.getLogger(__name__)

Clock = Callable[[], dt.datetime]
RowsOf = Callable[[str], DataFrame]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class Stamps:
    """Strictly increasing UTC times, one per recorded phase."""

    def __init__(self, clock: Clock = utc_now) -> None:
        self._clock = clock
        self._last: dt.datetime | None = None

    def __call__(self) -> Column:
        now = self._clock()
        if self._last is not None and now <= self._last:
            now = self._last + dt.timedelta(microseconds=1)
        self._last = now
        return F.lit(now)


def attempt_of(started_at: Column) -> Column:
    """What tells one attempt of a run from the next: the time it began."""
    return F.unix_micros(started_at).cast("string")


def derived_id(run_id: str, kind: str, attempt: Column) -> Column:
    """Id of a pair's record in one attempt of a run; appending the same record again repeats it."""
    pair = (F.col("delivery_date").cast("string"), F.col("source_object"))
    return F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(kind), *pair, attempt), 256)


def append_events(
    attempts: DataFrame,
    steps: Column,
    keep: Column,
    database: str,
    run_id: str,
    started_at: Column,
    recorded_at: Column,
    load_error: Column | None = None,
) -> None:
    """Append the transitions that ``keep`` selects among an attempt's steps."""
    rows = explode_steps(attempts, steps, run_id, attempt_of(started_at)).filter(keep)
    failed, ingestion = F.col("status") == "failed", F.col("stage") == "ingestion"
    if load_error is None:
        load_error = safe_error("warehouse_load_failed", "replay", "load", "Warehouse load failed")
    rows = rows.select(
        "run_id",
        "event_id",
        *PAIR,
        "status",
        "stage",
        started_at.alias("started_at"),
        F.when(F.col("status") != "running", recorded_at).alias("completed_at"),
        F.when(failed & ingestion, F.col("error_message")).when(failed, load_error).alias("error_message"),
        recorded_at.alias("recorded_at"),
    )
    append_ledger(rows, database, "replay_events")


def append_artifacts(attempts: DataFrame, database: str, run_id: str, recorded_at: Column) -> None:
    """Artifact provenance of every ingested pair; expects its landing facts as columns."""
    rows = attempts.select(
        F.col("provenance_id"),
        F.lit(run_id).alias("run_id"),
        *PAIR,
        "ingestion_date",
        "gcs_uri",
        "checksum",
        "file_size_bytes",
        "record_count",
        recorded_at.alias("recorded_at"),
    )
    append_ledger(rows, database, "artifact_provenance")


Pair = tuple[dt.date, str]


def load_sources(attempts: DataFrame, database: str, rows_of: RowsOf) -> list[Pair]:
    """Replace the partitions of every attempted pair and return the pairs that failed.

    All days of a source are published by one write.  Where it fails nothing was published, and the days are tried again
    in halves, so that a bad day fails alone: a few more writes for each bad day, and none where all is well.  What
    went wrong goes to the log, never into a ledger.  Errors of the plan itself, such as an absent table, and a lost
    session end the job.  The days of a range come to the driver, one date each.
    """
    failed: list[Pair] = []
    wanted: dict[str, list[dt.date]] = {}
    for row in attempts.select(*PAIR).distinct().collect():
        wanted.setdefault(row.source_object, []).append(row.delivery_date)
    for source in (s for s in DAILY_SOURCES if s in wanted):
        try:
            rows = rows_of(source)
        except (AnalysisException, Py4JNetworkError):
            raise
        except Exception as error:  # noqa: BLE001 - isolated per source, recorded as failed loads
            log.warning("rows of %s failed: %s", source, type(error).__name__)
            failed += [(day, source) for day in wanted[source]]
            continue
        parts = [sorted(wanted[source])]
        while parts:
            days = parts.pop()
            try:
                replace_partitions(rows, database, source, days)
            except (AnalysisException, Py4JNetworkError):
                raise
            except Exception as error:  # noqa: BLE001 - isolated per day, recorded as a failed load
                log.warning("load of %s failed for %d days from %s: %s", source, len(days), days[0], type(error).__name__)
                if len(days) == 1:
                    failed.append((days[0], source))
                else:
                    parts += [days[: len(days) // 2], days[len(days) // 2 :]]
    return failed


def with_loads(attempts: DataFrame, loadable: Column, failed: list[Pair]) -> DataFrame:
    """Add ``load_ok``: the pair was to be loaded, and its own partition was published."""
    if not failed:
        return attempts.withColumn("load_ok", loadable)
    bad = constant_table(attempts.sparkSession, failed, {"delivery_date": "date", "source_object": "string"})
    joined = attempts.join(bad.withColumn("load_failed", F.lit(True)), list(PAIR), "left")
    return joined.withColumn("load_ok", loadable & F.col("load_failed").isNull()).drop("load_failed")


def loaded_counts(spark: SparkSession, database: str, days: dict[str, list[dt.date]]) -> DataFrame:
    """Rows per loaded partition, read from the tables after the write; only the given days are read."""
    counts = spark.sql("SELECT '' AS source_object, DATE'0001-01-01' AS partition_date, 0L AS n WHERE false")
    for source, listed in days.items():
        counts = counts.unionByName(partition_counts(spark, database, source, listed))
    return counts


def append_loads(loaded: DataFrame, database: str, run_id: str, attempt: Column, recorded_at: Column) -> None:
    """Load provenance of every loaded pair, its row count taken from the table itself."""
    spark = loaded.sparkSession
    days: dict[str, list[dt.date]] = {}
    for row in loaded.select(*PAIR).distinct().collect():  # one date per day and source of the range
        days.setdefault(row.source_object, []).append(row.delivery_date)
    days = {s: sorted(d) for s, d in sorted(days.items()) if spark.catalog.tableExists(f"{database}.{s}")}
    counts = loaded_counts(spark, database, days).withColumnRenamed("partition_date", "delivery_date")
    source, day = F.col("source_object"), F.col("delivery_date")
    rows = loaded.join(counts, list(PAIR), "left").select(
        derived_id(run_id, "load", attempt).alias("load_id"),
        "provenance_id",
        F.lit(run_id).alias("run_id"),
        *PAIR,
        destination_id(database, source, day, is_transactional(source)).alias("destination"),
        day.alias("partition_date"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("output_rows"),
        F.concat_ws("-", F.lit(run_id), source).alias("job_id"),
        recorded_at.alias("recorded_at"),
    )
    append_ledger(rows, database, "load_provenance")
